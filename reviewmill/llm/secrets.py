"""Secret scan: candidates in texts, and a random forest that removes the false positives. DataFrame and ML functions only.

A candidate is a run of at least ``LEAST`` letters, digits and + / _ - that has a digit in it, or the value of an assignment to a name
such as password or token in any case, with quotes and blanks or without, of any length. Its features:

* length, and the share of different characters;
* character transitions: how often neighbouring characters go between capitals, small letters, digits and signs, per character;
* dictionary coverage: the share of its characters in runs of letters that are words of the corpus (in ``WORD_SHARE`` of its distinct texts);
* path: how often findings of the same source were secrets among the labelled ones;
* neighbouring words: the same for the two words before, the one after, and what stands before the value in its own word.

The forest is trained from labelled findings (``label_findings`` gives those that formats decide: well-known key formats and assignments of
non-words are secrets; numbers, dates, addresses and dictionary words are not; labels of other origin can be given) and then decides about all. Labels come from formats, the
features do not see them, so findings without a known format get a decision too.

Scale: texts are split and filtered in their rows, without a shuffle; only candidates, a few per document, go on. Corpus words are
counted once per distinct text, in each task before the shuffle; copies of a text are brought together by digest first. Training takes at most ``MAX_FINDINGS`` labelled findings, those with the least hash.

Edge cases: a NULL text has no findings; a NULL source is a path of its own; the same value twice in a text is two findings; repeated rows each
have theirs; with labelled findings of one kind or none, the share of secrets among them, or 0.5, is every score; an empty
table gives an empty table; other columns than doc_id, source and text are left out.
"""

from math import ceil

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .common import stored

LEAST = 12
WORD_SHARE = 0.001
MAX_FINDINGS = 50_000
TREES, DEPTH = 40, 6
SMOOTH = 2.0

RUN = r"[A-Za-z0-9+/_-]"
LONG = rf"(?<!{RUN})(?=[A-Za-z+/_-]*[0-9]){RUN}{{{LEAST},}}"
# A value after a name, also in the next words: 'password: x', 'token = "x"', '"api_key":"x"'. Words are put together with one blank.
ASSIGNED = rf"""(?<=(?i:pass|passwd|word|pwd|cret|oken|key)["']? ?[=:]{{1,2}}>? ?["']?){RUN}+"""
VALUE = rf"(?:{LONG}|{ASSIGNED})"
NAMES = r"(?i)(?:passw(?:or)?d|passwd|pwd|secret|token|api_?key)"
SPACE = r"[ \t-\r]+"

FEATURES = ["length", "different", "coverage", "path", "before", "before2", "after", "inside"]
KINDS = {"capital": "[A-Z]", "small": "[a-z]", "digit": "[0-9]", "sign": "[+/_-]"}
TRANSITIONS = [f"{a}_{b}" for a in KINDS for b in KINDS]


def _near(words, i):
    """A word with the two before it."""
    return F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1), F.get(words, i))


def _likely(words, i):
    """Whether a candidate may begin in word ``i``: all that have one, and few others."""
    word, before = F.get(words, i), F.get(words, i - 1)
    assigned = (word.rlike("[=:]") | before.rlike("""[=:]>?["']?$""")) & _near(words, i).rlike(ASSIGNED)
    return (F.octet_length(word) >= LEAST) & word.rlike(LONG) | F.coalesce(assigned, F.lit(False))


def candidates(docs):
    """One row per candidate: doc_id, source, at (number of the word in its text), nth (in the word), value, inside (the word before the value), before2, before, after."""
    def hits(words):
        likely = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: _likely(words, i))
        return F.transform(likely, lambda i: F.struct(
            i.alias("at"), F.get(words, i).alias("word"), F.get(words, i - 2).alias("before2"), F.get(words, i - 1).alias("before"), F.get(words, i + 1).alias("after"),
        ))

    # The split stands in an array of one, so that it is made once per text and not once per word.
    split = F.array(F.split(F.col("text"), SPACE))
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "source", F.transform(split, hits)[0].alias("hits"))
    rows = rows.where(F.size("hits") > 0).select("doc_id", "source", F.explode("hits").alias("hit")).select("doc_id", "source", "hit.*")
    # Matches over the word and the two before it, with what stands between them; those that begin in the word count.
    rows = rows.withColumn("near", F.concat_ws(" ", "before2", "before", "word"))
    rows = rows.withColumn("first", F.length("near") - F.length("word"))
    pattern = F.lit(f"(?s)(.*?)({VALUE})")
    rows = rows.withColumns({"upto": F.regexp_extract_all("near", pattern, F.lit(0)), "values": F.regexp_extract_all("near", pattern, F.lit(2))})

    def placed(value, n):
        ends = F.length(F.array_join(F.slice("upto", F.lit(1), n + 1), ""))
        return F.struct((ends - F.length(value)).alias("start"), value.alias("value"))

    own = F.filter(F.transform("values", placed), lambda v: v["start"] >= F.col("first"))
    rows = rows.select("*", F.posexplode(own).alias("nth", "found"))
    inside = F.col("near").substr(F.col("first") + 1, F.col("found.start") - F.col("first"))
    return rows.select("doc_id", "source", "at", "before2", "before", "after", "nth", F.col("found.value").alias("value"), inside.alias("inside"))


def corpus_words(docs, share=WORD_SHARE):
    """Words of three letters or more that are in ``share`` of the distinct texts and in two at least, lower-cased; values of candidates do not count."""
    texts = docs.where(F.col("text").isNotNull()).groupBy(F.md5("text").alias("code")).agg(F.first("text").alias("text"))
    texts = stored(texts.select("text"), "texts")
    least = max(2, ceil(share * texts.count()))

    def plain(words):
        others = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: (F.length(F.get(words, i)) >= 3) & ~_likely(words, i))
        return F.array_distinct(F.transform(others, lambda i: F.lower(F.regexp_replace(F.get(words, i), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))))

    words = texts.select(F.explode(F.transform(F.array(F.split(F.col("text"), SPACE)), plain)[0]).alias("word"))
    words = words.groupBy("word").agg(F.count("*").alias("n"))
    return words.where((F.col("n") >= least) & F.col("word").rlike(r"^\p{L}{3,}$")).select("word")


def describe(found, words):
    """Add the features that need no labels. ``found`` must be stored: its rows are numbered."""
    value = F.col("value")
    found = found.withColumns({
        "length": F.length(value).cast("double"),
        "different": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
    })
    size = F.length(value).cast("double")
    # Overlapping pairs, so the second character is only looked at.
    found = found.withColumns({f"{a}_{b}": F.regexp_count(value, F.lit(f"{x}(?={y})")) / size for a, x in KINDS.items() for b, y in KINDS.items()})
    parts = found.select("id", F.explode(F.regexp_extract_all(F.lower(value), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    covered = parts.join(words, "word", "left_semi").groupBy("id").agg(F.sum(F.length("word")).alias("covered"))
    found = found.join(covered, "id", "left")
    return found.withColumn("coverage", F.coalesce(F.col("covered"), F.lit(0)) / size).drop("covered")


def label_findings(found):
    """label: 1.0 secret, 0.0 not, NULL where no format decides."""
    value, near = F.col("value"), F.concat_ws(" ", "before2", "before", "inside")
    assigned = near.rlike(NAMES + r"""["']?\s*[:=]\s*["']?$""")
    known = value.rlike("^AKIA[0-9A-Z]{16}$") | value.rlike("^gh[pousr]_[0-9A-Za-z]{36}$") | value.rlike("^xox[abprs]-[0-9A-Za-z-]{10,}$")
    plain = value.rlike("^[0-9+/_-]+$") | value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}") | near.rlike(r"(?:@|://|www\.)\S*$") | (F.col("coverage") > 0.6)
    return found.withColumn("label", F.when(known | (assigned & (F.col("coverage") <= 0.6)), 1.0).when(plain, 0.0))


ENCODED = {"path": "source", "before": "before", "before2": "before2", "after": "after", "inside": "inside"}


def _key(name):
    return F.lower(F.coalesce(F.col(name).cast("string"), F.lit("\0")))


def encodings(labelled):
    """Per feature of ``ENCODED``: (key, n, secrets) over the labelled findings."""
    return {f: stored(labelled.groupBy(_key(c).alias("key")).agg(F.count("*").alias("n"), F.sum("label").alias("secrets")), "rates") for f, c in ENCODED.items()}


def encode(found, tables, base, own=False):
    """Replace each key by the smoothed share of secrets; ``own`` leaves the row's own label out, as training needs."""
    left = F.lit(1) if own else F.lit(0)
    mine = F.col("label") if own else F.lit(0.0)
    for feature, column in ENCODED.items():
        table = tables[feature].select(F.col("key").alias("_key"), F.col("n").alias("_n"), F.col("secrets").alias("_secrets"))
        found = found.withColumn("_of", _key(column)).join(table, F.col("_of") == F.col("_key"), "left")
        count, secrets = F.coalesce(F.col("_n") - left, F.lit(0)), F.coalesce(F.col("_secrets") - mine, F.lit(0.0))
        found = found.withColumn(f"f_{feature}", (secrets + SMOOTH * base) / (count + SMOOTH)).drop("_of", "_key", "_n", "_secrets")
    return found


def train(labelled):
    """A model from described findings with ``label``; a pair of the encodings' tables and the forest, and the base rate."""
    drawn = labelled.where(F.col("label").isNotNull())
    count = drawn.count()
    share = min(1.0, MAX_FINDINGS / max(1, count))
    drawn = stored(drawn.where(F.pmod(F.xxhash64("doc_id", "at", "value"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1), "labelled")
    base = drawn.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    if base[1] == base[2]:
        return None, None, 0.5 if base[0] is None else base[0]
    tables = encodings(drawn)
    columns = [c if c in ("length", "different", "coverage") else f"f_{c}" for c in FEATURES] + TRANSITIONS
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=3, featuresCol="features", labelCol="label", probabilityCol="probability")
    rows = stored(encode(drawn, tables, base[0], own=True).select("label", *columns), "training")
    return tables, Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), forest]).fit(rows), base[0]


def decide(found, model, accept=0.5):
    """score and secret of described findings."""
    tables, forest, base = model
    if forest is None:
        return found.withColumns({"score": F.lit(float(base)), "secret": F.lit(base >= accept)})
    scored = forest.transform(encode(found, tables, base))
    score = F.round(vector_to_array("probability")[1], 6)
    return scored.withColumn("score", score).withColumn("secret", F.col("score") >= accept)


def scan(docs, labelled=None):
    """Find, describe, learn and decide about all candidates.

    ``labelled`` are findings whose truth is known: doc_id, at, nth and label (1.0 for a secret). Without them, those that formats decide are the labelled ones.
    """
    docs = docs.select("doc_id", "source", "text")
    found = stored(candidates(docs).withColumn("id", F.monotonically_increasing_id()), "candidates")
    found = describe(found, corpus_words(docs))
    if labelled is None:
        found = label_findings(found)
    else:
        known = labelled.select("doc_id", "at", "nth", F.col("label").cast("double").alias("label")).dropDuplicates(["doc_id", "at", "nth"])
        found = found.join(known, ["doc_id", "at", "nth"], "left")
    found = stored(found, "findings")
    return decide(found, train(found))
