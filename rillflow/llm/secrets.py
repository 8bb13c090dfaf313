"""Secret scanning: candidate strings, and a random forest that removes false positives.

Candidates are long tokens with a digit, and whatever is given to a name that speaks of a secret (``password = "hunter2!"``),
however short and of whichever characters; the forest rejects. Their features are length and make-up, the likelihood of their character
transitions and the share that dictionary words cover, both learnt from all documents, the path of the
document, and the words around. The forest learns from labelled findings. All of it is DataFrame and ML pipeline
operations of the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.spans import row_key
from rillflow.workspace import land, scratch_path

BLANKS = r"[\x20\x09-\x0D]+"
LEAST_CHARS = 16
CANDIDATE = rf"[A-Za-z0-9+/=_.\-]{{{LEAST_CHARS},}}"
# Words that go with secrets, and the way values are given to names.
KEYWORDS = r"(?i)(key|token|secret|passw|pwd|auth|cred|private|bearer|signature)"
ASSIGNED = r"""[=:]["']?$|^[=:]+$"""
# Names of secrets, as they end; a value follows after an equals sign or colon.
SECRET_NAME = r"(?:passw(?:or)?d|passphrase|pwd|secret|token|credentials?|(?:api|access|private|secret|auth)[_\-]?key)"
# Every such name holds one of these.
NAME_PARTS = ("passw", "passphrase", "pwd", "secret", "token", "credential", "key")
QUOTE = r"""["'`]"""
NAME_ENDS = rf"(?i){SECRET_NAME}{QUOTE}?$"
NAME_GIVEN = rf"(?i){SECRET_NAME}{QUOTE}?[=:]+$"
NAME_AND_VALUE = rf"(?i){SECRET_NAME}{QUOTE}?[=:]+{QUOTE}?([^\x20\x09-\x0D\"'`]+)"
GIVEN_IN_TEXT = rf"(?i)({SECRET_NAME}{QUOTE}?[\x20\x09-\x0D]*[=:]+[\x20\x09-\x0D]*{QUOTE}?)[^\x20\x09-\x0D\"'`]+"
# A run of letters or digits that makes up this share of all runs is a dictionary word.
DICTIONARY_SHARE = 2e-5
# Smoothing of the transition table, as a share of all pairs.
SMOOTHING = 1e-6
# Symbols of the transition table: letters, one for digits, one for the rest; so it has 28 x 28 rows at most.
SYMBOLS = 28
PATH_BUCKETS = 16
FEATURES = [
    "length", "digit_share", "upper_share", "mark_share", "hex_only", "letter_digit_changes", "transitions", "coverage",
    "path_bucket", "path_depth", "keyword_before", "assigned", "quoted", "glued_before", "words_before", "before_bucket", "after_bucket",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``(id, mark, word, nth, candidate, token, before, before2, after, path)`` for every candidate of every text.

    ``word`` numbers the words of the text, ``nth`` the candidates within one: long strings in their order, then a value
    given to the name of a secret. Rows equal in id and text count once.
    """
    path = F.lit(None) if path_col is None else F.col(path_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), path.cast("string").alias("path"))
    identity, mark = row_key("id", "text")
    # Texts without a candidate end here, before they are split.
    names = _names_a_secret(F.col("text")) & F.col("text").rlike(GIVEN_IN_TEXT)
    rows = rows.withColumn("names", names).where(F.col("names") | F.col("text").rlike(CANDIDATE))
    rows = rows.select(identity.alias("id"), mark.alias("mark"), "text", "path", "names")
    words = F.col("words")
    found = rows.withColumn("words", F.split("text", BLANKS, -1)).drop("text")

    def worth(i: Column) -> Column:
        """Whether a word holds a candidate; regular expressions run only where cheaper tests allow it."""
        word, before = F.get(words, i), F.get(words, i - 1)
        near = [F.contains(word, F.lit(mark)) | F.coalesce(F.endswith(before, F.lit(mark)), F.lit(False)) for mark in "=:"]
        given = F.col("names") & (near[0] | near[1]) & _given(word, before, F.get(words, i - 2)).isNotNull()
        return ((F.length(word) >= LEAST_CHARS) & word.rlike(CANDIDATE)) | given

    at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), worth)
    found = found.withColumn("word", F.explode(at)).select(
        "id", "mark", "path", "word", F.get(words, F.col("word")).alias("token"),
        F.get(words, F.col("word") - 1).alias("before"), F.get(words, F.col("word") - 2).alias("before2"), F.get(words, F.col("word") + 1).alias("after"),
    )
    long = F.regexp_extract_all("token", F.lit(CANDIDATE), 0)
    given = _given(F.col("token"), F.col("before"), F.col("before2"))
    listed = F.array_contains(F.filter(long, lambda c: c.rlike("[0-9]")), given)
    own = F.concat(
        F.transform(long, lambda c: F.struct(c.alias("candidate"), c.rlike("[0-9]").alias("counts"))),
        F.array(F.struct(given.alias("candidate"), (given.isNotNull() & ~F.coalesce(listed, F.lit(False))).alias("counts"))),
    )
    found = found.select("*", F.posexplode(own).alias("nth", "one")).where("one.counts").select("*", "one.candidate").drop("one")
    return found.dropDuplicates(["id", "mark", "word", "nth"])


def _given(token: Column, before: Column, before2: Column) -> Column:
    """The value that a word gives to the name of a secret in it or before it; NULL without one."""
    inner = F.regexp_extract(token, NAME_AND_VALUE, 1)
    named = F.coalesce(before.rlike(NAME_GIVEN) | (before.rlike("^[=:]+$") & before2.rlike(NAME_ENDS)), F.lit(False))
    value = F.when(inner != "", inner).when(named & ~token.rlike("^[=:]+$"), token)
    bare = F.regexp_replace(value, r"""^["'`(\[{<]+|["'`)\]}>,;.]+$""", "")
    return F.nullif(bare, F.lit(""))


def _names_a_secret(text: Column) -> Column:
    """Whether a text holds a part of a secret's name, a cheap test that spares most texts the search for values."""
    lower = F.lower(text)
    return reduce(Column.__or__, [F.contains(lower, F.lit(part)) for part in NAME_PARTS])


def _plain(text: Column) -> Column:
    """Lower case, one symbol for digits."""
    return F.regexp_replace(F.lower(text), "[0-9]", "0")


def vocabulary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(token, n)``: letter and digit runs of all texts but those of candidates, counted before they are shuffled."""
    text = F.col(text_col).cast("string")
    text = F.regexp_replace(F.when(_names_a_secret(text), F.regexp_replace(text, GIVEN_IN_TEXT, "$1")).otherwise(text), CANDIDATE, " ")
    runs = F.explode(F.split(_plain(text), "[^a-z0]+")).alias("token")
    return docs.select(runs).where("token <> ''").groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def _pairs(text: str) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1))), lambda i: F.substring(F.col(text), i, F.lit(2)))


def transitions(words: DataFrame) -> DataFrame:
    """``(pair, logp)``: smoothed log likelihoods of the second symbol of a pair after its first."""
    pairs = words.where("length(token) > 1").select(F.explode(_pairs("token")).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    first = F.substring("pair", 1, 1)
    totals = pairs.groupBy(first.alias("a")).agg(F.sum("n").alias("total"))
    # Shares, so that a corpus and two copies of it give the same table.
    every = float(pairs.agg(F.sum("n")).first()[0] or 1)
    logp = F.log((F.col("n") / every + SMOOTHING) / (F.col("total") / every + SMOOTHING * SYMBOLS))
    return pairs.join(totals, first == F.col("a")).select("pair", logp.alias("logp"))


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")


def featured(found: DataFrame, words: DataFrame, dictionary_share: float = DICTIONARY_SHARE) -> DataFrame:
    """``found`` with ``FEATURES``; a dictionary word is one that makes up ``dictionary_share`` of all runs of ``words``."""
    least = dictionary_share * float(words.agg(F.sum("n")).first()[0] or 0)
    keys = ["id", "mark", "word", "nth"]
    same = lambda a, b: F.expr(" and ".join(f"{a}.{k} <=> {b}.{k}" for k in keys))
    # Transitions: a table of a few hundred rows at most, whatever the corpus.
    pairs = found.select(*keys, F.regexp_replace(_plain(F.col("candidate")), "[^a-z0]", "-").alias("c")).select(*keys, F.explode(_pairs("c")).alias("pair"))
    likely = pairs.join(F.broadcast(transitions(words)), "pair", "left").groupBy(*keys).agg(F.avg(F.coalesce("logp", F.lit(-12.0))).alias("transitions"))
    # Coverage: letter runs that are dictionary words.
    runs = found.select(*keys, F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{3,}"), 0)).alias("token"))
    known = runs.join(words.where(F.col("n") >= least).select("token"), "token").groupBy(*keys).agg(F.sum(F.length("token")).alias("covered"))
    base = found.alias("f").join(likely.alias("t"), same("f", "t"), "left").select("f.*", "t.transitions")
    base = base.alias("f").join(known.alias("d"), same("f", "d"), "left").select("f.*", "d.covered")
    glued = F.when(F.col("token").rlike(CANDIDATE), F.regexp_extract("token", f"^(.*?){CANDIDATE}", 1)).otherwise(F.expr("substring_index(token, candidate, 1)"))
    near = F.concat_ws(" ", "before2", "before", glued)
    bucket = lambda c, n: F.when(c.isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(c), F.lit(n)))
    values = {
        "length": F.length("candidate"),
        "digit_share": _share("[0-9]"),
        "upper_share": _share("[A-Z]"),
        "mark_share": _share(r"[+/=_.\-]"),
        "hex_only": F.col("candidate").rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("int"),
        "letter_digit_changes": F.regexp_count("candidate", F.lit("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]")) / F.length("candidate"),
        "transitions": F.coalesce("transitions", F.lit(-12.0)),
        "coverage": F.coalesce("covered", F.lit(0)) / F.length("candidate"),
        "path_bucket": bucket(F.lower(F.regexp_extract("path", r"([^./]*)$", 1)), PATH_BUCKETS),
        "path_depth": F.coalesce(F.regexp_count("path", F.lit("/")), F.lit(0)),
        "keyword_before": near.rlike(KEYWORDS).cast("int"),
        "assigned": (F.coalesce(F.col("before"), F.lit("")).rlike(ASSIGNED) | glued.rlike(ASSIGNED)).cast("int"),
        "quoted": F.col("token").rlike(r"""["'`]""").cast("int"),
        "glued_before": F.length(glued),
        "words_before": F.least("word", F.lit(2)),
        "before_bucket": bucket(F.lower("before"), 32),
        "after_bucket": bucket(F.lower("after"), 32),
    }
    return base.select(*found.columns, *(values[f].cast("double").alias(f) for f in FEATURES))


@dataclass
class SecretModel:
    """A forest, or the share of true findings if there was only one kind to learn from."""

    forest: RandomForestClassificationModel | None
    share: float = 0.0

    def scores(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``score``, the likelihood that a finding is a secret."""
        if self.forest is None:
            return rows.withColumn("score", F.lit(self.share))
        done = self.forest.transform(_assembled(rows))
        return done.select(*rows.columns, F.get(vector_to_array("probability"), F.lit(1)).alias("score"))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def train(rows: DataFrame, label_col: str = "label", max_rows: int = 100_000, trees: int = 20, depth: int = 6, seed: int = 7) -> SecretModel:
    """Fit on findings with ``FEATURES`` and a label of 0 or 1; rows without a label are ignored.

    At most ``max_rows`` findings are used, those with the lowest hashes: a bounded sample for fitting only.
    """
    marked = rows.where(F.col(label_col).isin(0, 1)).select(*FEATURES, F.col(label_col).cast("double").alias("label"), F.xxhash64("id", "mark", "word", "nth").alias("order"))
    sample = land(marked.orderBy("order").limit(max_rows).drop("order"), "findings")
    counts = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return SecretModel(None, float(1.0 in counts))
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    # A fitted model holds its training summary and so the session; one read from its folder goes to tasks whatever the session holds.
    path = scratch_path(rows.sparkSession, "forest")
    forest.fit(_assembled(sample)).save(path)
    return SecretModel(RandomForestClassificationModel.load(path))


def scan(docs: DataFrame, labels: DataFrame | Column, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", **options) -> DataFrame:
    """``(id, mark, word, nth, candidate, <features>, score)`` for every candidate of every document.

    ``labels`` are labelled findings to learn from: rows ``(id, word, nth, label)``, or a column over the
    candidates and their features that gives 1, 0, or NULL for no label. Without two kinds of labels
    all scores are 1 or 0 alike. A NULL or empty text has no candidates, a NULL path is a kind of its own, NULL ids are kept,
    rows equal in id and text count once, and other columns are ignored. An empty table gives no rows.
    """
    words = land(vocabulary(docs, text_col), "vocabulary")
    found = land(candidates(docs, id_col, text_col, path_col), "candidates")
    rows = land(featured(found, words, **options), "featured")
    if isinstance(labels, DataFrame):
        said = labels.select(F.col(id_col).alias("l_id"), F.col("word").alias("l_word"), F.col("nth").alias("l_nth"), "label")
        marked = rows.join(said, F.col("id").eqNullSafe(F.col("l_id")) & (F.col("word") == F.col("l_word")) & (F.col("nth") == F.col("l_nth")))
    else:
        marked = rows.withColumn("label", labels)
    scored = train(marked).scores(rows)
    return scored.select(F.col("id").alias(id_col), "mark", "word", "nth", "candidate", *FEATURES, "score")


def review(row_id: str = "id") -> Column:
    """Labels as a reviewer gives them to findings of three quarters of the documents, by their ids; the rest are held out.

    An assigned or quoted value next to a secret's name is a secret; part of an address or a plain number is not. The
    others are left open.
    """
    known = F.col("keyword_before").cast("boolean") & (F.col("assigned").cast("boolean") | F.col("quoted").cast("boolean")) & (F.col("coverage") < 0.5)
    harmless = F.col("token").contains("@") | F.col("token").contains("://") | F.col("candidate").rlike("^[0-9.+-]+$") | (F.col("coverage") > 0.6)
    learning = F.crc32(F.coalesce(F.col(row_id).cast("string"), F.lit("")).cast("binary")) % 4 != 2
    return F.when(learning & known, 1).when(learning & harmless, 0)
