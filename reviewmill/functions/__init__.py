from .buckets import BUCKETS, bucket_of, in_share
from .text import (
    decode_lines, encode_lines, extract_between, clean_line, normal_tokens, normal_words,
    plain_words, quoted, tokens, without_links,
)
