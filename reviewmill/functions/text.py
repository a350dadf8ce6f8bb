"""Column expressions on text. All are built-ins and stay inside generated code."""

from pyspark.sql import functions as F

# Fixed value: what counts as a link.
LINK_PATTERN = r"http[s]?:\S+|www\.[^\s]*"


def without_links(text):
    return F.regexp_replace(text, LINK_PATTERN, "")


def tokens(text):
    """Lower-cased words between white space; no empty ones."""
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")


def normal_tokens(words):
    """Each word cut down to its letters; words without letters go.

    The words are joined so that one regular expression runs per row, in generated code, instead of
    one per word in an interpreted lambda.
    """
    return F.array_remove(F.split(F.regexp_replace(F.array_join(words, " "), r"[^\p{L} ]+", ""), " "), "")


def normal_words(text):
    """``normal_tokens(tokens(text))`` straight from the text."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\s]+", ""), r"\s+"), "")


def plain_words(text):
    """Lower-cased text cut at every single white space, as Spark's ``Tokenizer`` does it: empty words
    stay inside the text and go at its end."""
    trimmed = F.rtrim(F.lower(text), F.lit(" \t\n\x0b\f\r"))
    blank = (trimmed == "") & (text != "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s"))


def clean_line(line):
    """Quote bare nulls and drop escaped line ends in a raw JSON line."""
    line = F.replace(line, F.lit(":null"), F.lit(':"null"'))
    line = F.replace(line, F.lit("\\n"), F.lit(""))
    return F.replace(line, F.lit("\\r"), F.lit(""))


def extract_between(line, first, second):
    """Text after the name ``first`` up to the name ``second``, without quotes and colons.

    Both names are looked up from the start of the line. NULL when a name is missing, empty when
    ``second`` comes first.
    """
    start = F.instr(line, first) + len(first)
    end = F.instr(line, second)
    found = (F.instr(line, first) > 0) & (end > 0)
    inner = F.substring(line, start, F.greatest(end - start, F.lit(0)))
    return F.when(found, F.translate(inner, '":', ""))


def quoted(value, null_text="null"):
    """``"value"`` with inner quotes doubled. A NULL is the quoted ``null_text``, or nothing at all for None."""
    text = value if null_text is None else F.coalesce(value, F.lit(null_text))
    field = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(field, F.lit(""))


def encode_lines(text):
    r"""Keep a text on one line: backslash -> ``\s``, line feed -> ``\n``, return -> ``\r``."""
    for plain, code in (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def decode_lines(text):
    """Undo ``encode_lines``. After encoding, every backslash starts exactly one code."""
    for plain, code in (("\n", "\\n"), ("\r", "\\r"), ("\\", "\\s")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text
