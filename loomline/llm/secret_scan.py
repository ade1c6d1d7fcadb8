"""Secret scan: broad detection, then a random forest that removes false positives.

Detection takes every value that could be a credential, all of them where a word holds
several: a run of twelve or more characters of codes with a digit or with changing case, a
value assigned to a word like ``password``, within one word or with spaces about the sign,
and a key from its header to its end. A private key is a secret by its header. Most of the rest is harmless (addresses, numbers, names of things).
The forest judges each finding by its length, its character transitions (share of changes
of class, and mean log-likelihood of its letter pairs under the corpus dictionary), the share
of its letters that dictionary words cover, the path or address it stands in, and the words
around it. It learns from labelled findings, at most ``TRAINING_ROWS`` of each label.

``marked_by_format`` labels findings where no labelled ones are at hand: credentials that a
provider's format or an assignment gives away against all others. The forest sees neither
the format nor the name that a value is assigned to.

The dictionary is counted over all documents and holds all their words. All work is DataFrame
expressions and Spark ML.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import checkpointed, sized_broadcast, small_partitions

TRAINING_ROWS = 10_000
# Up to this many dictionary words beside findings are broadcast, more are joined by shuffle.
KNOWN_ROWS = 100_000
TREES, DEPTH = 40, 8
LIMIT = 0.5
MASK = "[SECRET]"
# Words that name a credential, and formats that providers document.
NAMES = r"password|passwd|passphrase|pwd|secret|token|api[_\-]?key|access[_\-]?key|private[_\-]?key|credential|auth"
FORMATS = (
    r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[opsu]_[0-9A-Za-z]{36,}$|^github_pat_[0-9A-Za-z_]{22,}$|^xox[abprs]-[0-9A-Za-z\-]{10,}$"
    r"|^sk_(live|test)_[0-9A-Za-z]{16,}$|^sk-[0-9A-Za-z_\-]{20,}$|^AIza[0-9A-Za-z_\-]{35}$|^glpat-[0-9A-Za-z_\-]{20,}$"
    r"|^eyJ[0-9A-Za-z_\-]{8,}\.[0-9A-Za-z_\-]+\.[0-9A-Za-z_\-]+$"
)
_SPACES = r"[\x20\x09-\x0D]+"
_RUN = r"[0-9A-Za-z+/_.@\-]{12,}"
_CODE = rf"(?=[A-Za-z+/_.@\-]*[0-9]|[A-Z0-9+/_.@\-]*[a-z]+[A-Z]){_RUN}"
_ASSIGNED = rf"(?i)({NAMES})[\"']?[=:]+[\"']?[^\x20\x09-\x0D\"']{{6,}}"
_KEY_HEADER = r"-----BEGIN"
# From a key's header to its end; without an end, to the last line of the body.
_KEY = (
    r"(-----BEGIN[A-Z0-9 ]*+-----[^-]*+(?:-{1,4}(?!-)[^-]*+)*+-----END[^-\n]*+(?:-----)?"
    r"|-----BEGIN[A-Z0-9 ]*+(?:-----)?(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{20,}+)*+)"
)
_PRIVATE_KEY = r"^-----BEGIN[A-Z0-9 ]*PRIVATE KEY"
_NAMED = rf"(?i)^[\"']?([a-z]+[_\-.])*({NAMES})[\"']?([=:]+>?)?$"
_SIGN = r"^[=:]+>?$"
_NAME_END = rf"(?i)(^|[^a-z])({NAMES})[\"']?$"
_NAME_SIGN_END = rf"(?i)(^|[^a-z])({NAMES})[\"']?[=:]+>?$"
_SPACED = rf"(?i)({NAMES})[\"']?([=:]+>?[\x20\x09-\x0D]|[\x20\x09-\x0D]+[=:])"
# A value ends with the word, at a quote, or before the next name and sign.
_VALUE = r"([^\x20\x09-\x0D\"'<>]{6,}?)(?=[\"'.,;:!?)\]}>]*$|[\"'<>]|[,;&|{}]+[\"']?[\w.\-]+[\"']?[=:])"
_ASSIGNED_VALUE = rf"(?i)(?:{NAMES})[\"']?[=:]+>?[\"']?{_VALUE}"
_FOLLOWING_VALUE = rf"^[=:]*>?[\"'(\[{{]*{_VALUE}"

FEATURES = [
    "length", "digits", "uppers", "vowels", "distinct_share", "changes", "pair_score", "longest_letters", "coverage",
    "dots", "slashes", "ats", "assigned", "quoted", "sign_before", "known_before", "known_after", "hex_only", "digits_only",
]


def findings(docs: DataFrame) -> DataFrame:
    """``(doc_id, position, word, value, before, second, after, by_name)``: values that may be secrets.

    ``position`` counts words from 0; ``before``, ``second`` and ``after`` are neighbouring
    words, empty where there is none. A word gives each of its values once; ``by_name`` says
    that a credential's name and a sign stand before the value. A key is one finding at the
    word of its header. Null and empty texts have no findings.
    """
    text = F.col("text").cast("string")
    docs = small_partitions(docs.select("doc_id", "text"))
    split = lambda t: F.array_remove(F.split(t, _SPACES), "")

    def span(k: Column) -> Column:
        ahead = F.substring(text, F.lit(1), F.instr(text, k) - 1)
        first = F.size(split(ahead)) - F.when(ahead.rlike(r"[^\x20\x09-\x0D]$"), 1).otherwise(0)
        return F.struct(first.alias("first"), (first + F.size(split(k))).alias("stop"), k.alias("key"))

    keys = F.when(text.contains(_KEY_HEADER), F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(_KEY), 1)), span))
    words = docs.where(
        text.rlike("[0-9]") | text.contains(_KEY_HEADER) | text.rlike(_ASSIGNED) | text.rlike(_SPACED) | text.rlike(_CODE)
    ).select("doc_id", split(text).alias("words"), F.coalesce(keys, F.array().cast("array<struct<first:int,stop:int,key:string>>")).alias("keys"))
    word = lambda i: F.get(F.col("words"), i)
    near = lambda i, k: F.coalesce(F.get(F.col("words"), i + k), F.lit(""))

    def follows(i: Column) -> Column:
        """A credential's name and a sign stand before the value, with spaces about the sign."""
        b = near(i, -1)
        joined = (b.endswith("=") | b.endswith(":") | b.endswith(">")) & b.rlike(_NAME_SIGN_END)
        apart = (b.startswith("=") | b.startswith(":")) & b.rlike(_SIGN) & near(i, -2).rlike(_NAME_END)
        ahead = (word(i).startswith("=") | word(i).startswith(":")) & b.rlike(_NAME_END)
        return (F.length(word(i)) >= 6) & (joined | apart | ahead)

    def suspect(i: Column) -> Column:
        w = word(i)
        return ((F.length(w) >= 10) & (w.rlike(_CODE) | w.rlike(_ASSIGNED))) | follows(i)

    in_key = lambda i: F.exists("keys", lambda k: (i >= k["first"]) & (i < k["stop"]))
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: suspect(i) & ~in_key(i))
    neighbours = lambda i: [near(i, k).alias(n) for k, n in ((-1, "before"), (-2, "second"), (1, "after"))]
    none = F.lit(None).cast("string").alias("key")
    at = F.concat(
        F.transform(places, lambda i: F.struct(i.alias("position"), word(i).alias("word"), *neighbours(i), follows(i).alias("follows"), none)),
        F.transform("keys", lambda k: F.struct(
            k["first"].alias("position"), word(k["first"]).alias("word"), *neighbours(k["first"]), F.lit(False).alias("follows"), k["key"].alias("key")
        )),
    )
    out = words.where(F.size("words") > 0).select("doc_id", F.explode(at).alias("f")).select("doc_id", "f.*")
    assigned = F.array_distinct(F.concat(
        F.regexp_extract_all("word", F.lit(_ASSIGNED_VALUE), 1),
        F.when(F.col("follows"), F.array(F.regexp_extract("word", _FOLLOWING_VALUE, 1))).otherwise(F.array().cast("array<string>")),
    ))
    assigned = F.array_remove(assigned, "")
    code = F.transform(F.regexp_extract_all("word", F.lit(f"({_CODE})"), 1), lambda c: F.rtrim(c, F.lit(".-")))
    out = out.withColumns({"_named": F.when(F.col("key").isNull(), assigned).otherwise(F.array("key")), "_codes": F.array_distinct(code)})
    # a code inside an assigned value is part of it
    other = F.filter("_codes", lambda c: ~F.exists("_named", lambda a: a.contains(c)))
    values = F.when(F.col("key").isNull(), F.concat("_named", other)).otherwise(F.col("_named"))
    out = out.withColumn("value", F.explode(values)).withColumn("by_name", F.array_contains("_named", F.col("value")))
    return out.where(F.length("value") >= 6).drop("follows", "key", "_named", "_codes")


def dictionary(docs: DataFrame) -> DataFrame:
    """``(entry, n)``: the words of three letters or more, counted over all documents."""
    every = small_partitions(docs.select("text")).select(
        F.explode(F.split(F.lower(F.col("text").cast("string")), _SPACES)).alias("w")
    )
    entry = F.rtrim(F.col("w"), F.lit(".,;:!?"))
    counted = every.select(entry.alias("entry")).where(F.length("entry").between(3, 24)).groupBy("entry").agg(F.count(F.lit(1)).alias("n"))
    return checkpointed(counted.where(F.col("entry").rlike(r"^\p{L}+$")))


def _pairs(text: Column) -> Column:
    """Adjacent pairs of letters or digits, lower case, digits as one sign."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), "[^a-z0]", "-")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(plain) - 1, F.lit(1))), lambda i: F.substr(plain, i, F.lit(2)))


def pair_scores(entries: DataFrame) -> dict[str, float]:
    """Log-likelihood of the second character of each pair; at most 28 x 28 of them."""
    pair = entries.select(F.explode(_pairs(F.col("entry"))).alias("pair"), "n").where(F.length("pair") == 2)
    counts = pair.groupBy("pair").agg(F.sum("n").alias("n"))
    first = counts.groupBy(F.substring("pair", 1, 1).alias("head")).agg(F.sum("n").alias("all"))
    joined = counts.withColumn("head", F.substring("pair", 1, 1)).join(first, "head")
    rows = joined.select("pair", F.log((F.col("n") + 1) / (F.col("all") + 28)).alias("score")).collect()
    return {r.pair: float(r.score) for r in rows}


_UNSEEN = -8.0


def with_features(found: DataFrame, entries: DataFrame, scores: dict[str, float]) -> DataFrame:
    """Stored ``found`` with the columns ``FEATURES``."""
    v, n = F.col("value"), F.length("value")
    count = lambda pattern: F.regexp_count(v, F.lit(pattern))
    table = F.create_map(*[x for k, s in sorted(scores.items()) for x in (F.lit(k), F.lit(s))]) if scores else None
    pair_sum = F.aggregate(
        _pairs(v), F.lit(0.0), lambda a, p: a + (F.coalesce(F.try_element_at(table, p), F.lit(_UNSEEN)) if scores else F.lit(0.0))
    )
    letters = F.regexp_extract_all(v, F.lit("([A-Za-z]+)"), 1)
    changes = count("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    plain = found.select(
        "*", n.cast("double").alias("length"), (count("[0-9]") / n).alias("digits"), (count("[A-Z]") / n).alias("uppers"),
        (count("(?i)[aeiouy]") / F.greatest(count("[A-Za-z]"), F.lit(1))).alias("vowels"),
        (F.size(F.array_distinct(F.split(v, ""))) / n).alias("distinct_share"),
        (changes / F.greatest(n - 1, F.lit(1))).alias("changes"), (pair_sum / F.greatest(n - 1, F.lit(1))).alias("pair_score"),
        F.coalesce(F.array_max(F.transform(letters, F.length)), F.lit(0)).cast("double").alias("longest_letters"),
        count("[.]").cast("double").alias("dots"), count("/").cast("double").alias("slashes"), count("@").cast("double").alias("ats"),
        flag(F.col("word").rlike("[=:]")).alias("assigned"), flag(F.col("word").rlike("[\"']")).alias("quoted"),
        flag(F.col("before").rlike("^[=:]+>?$")).alias("sign_before"),
        flag(v.rlike("^[0-9a-f]+$")).alias("hex_only"), flag(v.rlike("^[0-9.]+$")).alias("digits_only"),
    )
    key = ["doc_id", "position", "value"]
    parts = plain.select(*key, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(v), F.lit("([a-z]{3,})"), 1))).alias("entry"))
    # repeated rows count once; a null id is an id like any other
    parts = parts.distinct()
    tidy = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}]+$|^[^\p{L}]+", ""))
    # of the dictionary, the words that the findings ask for: each asked once
    asked = found.select(F.explode(F.concat(
        F.regexp_extract_all(F.lower(v), F.lit("([a-z]{3,})"), 1), F.array(tidy(F.col("before")), tidy(F.col("after")))
    )).alias("entry")).distinct()
    known = checkpointed(asked.join(entries.select("entry"), "entry", "left_semi"))
    known = sized_broadcast(known, KNOWN_ROWS)
    hits = parts.join(known, "entry").groupBy(*key).agg(F.sum(F.length("entry")).alias("covered"))
    hits = hits.select(F.col("doc_id").alias("_id"), F.col("position").alias("_at"), F.col("value").alias("_value"), "covered")
    joined = (
        plain.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("position") == F.col("_at")) & (F.col("value") == F.col("_value")), "left")
        .drop("_id", "_at", "_value")
        .withColumns({"_b": tidy(F.col("before")), "_a": tidy(F.col("after"))})
    )
    for name, c in (("known_before", "_b"), ("known_after", "_a")):
        joined = joined.join(known.select(F.col("entry").alias(c), F.lit(1.0).alias(name)), c, "left")
    total = F.greatest(F.regexp_count(v, F.lit("[A-Za-z]")), F.lit(1))
    return joined.withColumn("coverage", F.coalesce("covered", F.lit(0)) / total).na.fill(
        0.0, ["known_before", "known_after"]
    ).drop("covered", "_a", "_b")


def marked_by_format(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: 1.0 for a provider's format, an assigned or a named value, else 0.0."""
    named = F.col("before").rlike(_NAMED) | (F.col("before").rlike("^[=:]+>?$") & F.col("second").rlike(_NAMED))
    sure = F.col("value").rlike(FORMATS) | F.col("by_name") | named | F.col("value").startswith(_KEY_HEADER)
    return found.withColumn("label", sure.cast("double"))


@dataclass
class Scanner:
    """Dictionary, pair scores and forest; without a forest every finding scores ``otherwise``."""

    entries: DataFrame
    scores: dict[str, float]
    forest: RandomForestClassificationModel | None
    otherwise: float = 1.0

    def judged(self, found: DataFrame) -> DataFrame:
        """``found`` with its features and ``score``, the forest's probability of a secret."""
        x = with_features(found, self.entries, self.scores)
        if self.forest is None:
            return x.withColumn("score", F.lit(self.otherwise))
        score = F.get(vector_to_array("probability"), F.lit(1))
        score = F.when(F.col("value").rlike(_PRIVATE_KEY), 1.0).otherwise(score)
        return self.forest.transform(_assembled(x)).withColumn("score", score)


def _assembled(x: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(x)


def train(labelled: DataFrame, entries: DataFrame, rows: int = TRAINING_ROWS) -> Scanner:
    """Scanner from findings with ``label`` (0.0 or 1.0); each label teaches by at most ``rows`` of them.

    Where only one label occurs, it is every finding's; without any, all are reported.
    """
    scores = pair_scores(entries)
    order = F.xxhash64("doc_id", "position", "value")
    sample = [labelled.where(F.col("label") == y).orderBy(order).limit(rows) for y in (0.0, 1.0)]
    sample = checkpointed(sample[0].unionByName(sample[1]))
    known = [r.label for r in sample.select("label").distinct().collect()]
    if len(known) < 2:
        return Scanner(entries, scores, None, known[0] if known else 1.0)
    x = checkpointed(with_features(sample, entries, scores).select("label", *FEATURES))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=2, seed=17, featuresCol="features")
    return Scanner(entries, scores, forest.fit(_assembled(x)))


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``(doc_id, position, value, score)`` of every finding; ``score >= LIMIT`` is a secret.

    ``labelled`` are findings with ``label``; by default those of ``docs`` marked by format.
    Null and empty texts and an empty table give no rows; repeated rows repeat their findings.
    """
    found = checkpointed(findings(docs))
    scanner = train(marked_by_format(found) if labelled is None else labelled, dictionary(docs))
    return scanner.judged(found).select("doc_id", "position", "word", "value", "score")


def mask_secrets(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``docs`` with the secrets of each text replaced by ``MASK``; all rows and columns stay."""
    # rows without an id are known by their text
    key = F.coalesce(
        F.concat(F.lit("="), F.col("doc_id").cast("string")), F.concat(F.lit("-"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))), F.lit("-")
    )
    keyed = docs.select("text", key.alias("doc_id"))
    hits = scan(keyed).where(F.col("score") >= limit).groupBy("doc_id").agg(F.collect_set("value").alias("_secrets"))
    # longer ones first: a secret may contain another
    ordered = F.array_sort("_secrets", lambda a, b: F.length(b) - F.length(a))
    hits = hits.select(F.col("doc_id").alias("_id"), ordered.alias("_secrets"))
    masked = F.aggregate("_secrets", F.col("text"), lambda t, s: F.replace(t, s, F.lit(MASK)))
    text = F.when(F.col("_secrets").isNull(), F.col("text")).otherwise(masked)
    joined = docs.join(sized_broadcast(checkpointed(hits), 100_000), key == F.col("_id"), "left")
    return joined.withColumn("text", text).select(*docs.columns)
