"""Secret scans with false positives removed by a random forest. SQL functions
and Spark ML only.

A pattern proposes findings: values of six characters or more assigned to a name
like "token" (in quotes, or with a digit), other long tokens with a digit, tokens
that begin like the keys of known issuers, and private key headers. A name before
"=" is no part of the finding. Splitting the text at the
same pattern gives what stands between them, so places and neighbouring text
need no second search. A finding is described by its length, its character
classes and the changes between them, the share of it that dictionary words
cover, the path of its document, and the words around it. The dictionary is that
of the corpus: words that stand alone in ``WORD_DOCS`` documents or more.

The forest is trained on labelled findings. They can be given; without them,
rules label those findings that are clear (keys of known issuers, and values
assigned to a name like "token", against plain numbers, placeholders, and
digests named as such). Such evidence is missing where the rules say nothing, so
each labelled finding is trained on twice, once without its evidence: there the
forest has to go by format, dictionary, path and neighbouring words, and so it
decides on findings that the rules leave open. The labelled rows are a bounded sample of ``SAMPLE_ROWS``, ordered by a hash; copies
of a finding are one row with their number as weight. Where
the sample has one class only, every finding gets the share of positives.

Null and empty texts have no findings; long texts are scanned whole; repeated
rows are each scanned and get equal scores, since a score depends on the finding
and its neighbourhood alone; an empty table gives no rows; ``source`` serves as path where there is such a column.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslab.functions.arrays import once
from corpuslab.operators.skew import lookup_join
from corpuslab.session import via_table

from .common import documents

SAMPLE_ROWS = 10_000
TREES, DEPTH = 40, 8
NEAR_WORDS = 64
WORD_DOCS = 3
THRESHOLD = 0.5
NEAR = 40

TOKEN = "A-Za-z0-9+/_"
#: "=" belongs to a token as padding at its end only.
PADDING = f"(?:=++(?![{TOKEN}\"'`-]))?+"
#: How keys of known issuers begin.
ISSUED = "AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abps]-|sk_live_|rk_live_|sk-|AIza|ya29|SG[.]|npm_|eyJ"
HEADER = "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
#: Names that secrets are assigned to, by width.
NAMES = {
    3: "pwd", 4: "auth", 5: "token", 6: "passwd|secret|apikey|bearer", 7: "api[ _-]key", 8: "password", 9: "accesskey|secretkey",
    10: "access[ _-]key|secret[ _-]key|privatekey|credential", 11: "private[ _-]key",
}
#: Characters between a name and the sign, and between the sign and the value.
BEFORE_SIGN, AFTER_SIGN = 12, 3
QUOTE = "\"'`"
BARE, QUOTED = f" \t\r\n{QUOTE},;&<>(){{}}=:", f" \t\r\n{QUOTE}"


def _named() -> str:
    """A place after a name, "=" or ":", and blanks or a quote. Lookbehinds of
    one width each, as not all engines take others, the sign first, so that most
    places cost little."""
    name = "|".join(f"(?<=(?i:{same}))" for same in NAMES.values())
    between = ["", *(f"[^A-RT-Za-rt-z\r\n][^\r\n=,;]{{{more}}}" for more in range(BEFORE_SIGN))]
    sign = "|".join(f"(?<=(?:{name}){gap}[=:])" for gap in between)
    blanks = [f"[ \t>{QUOTE}]{{{after}}}" for after in range(AFTER_SIGN + 1)]
    return "(?:" + "|".join(f"(?<=[=:]{after})(?<=(?:{sign}){after})" for after in blanks) + ")"


#: A token starts after a character that no token has, so the search is linear.
PATTERN = (
    f"{HEADER}|(?<![{TOKEN}-])(?:{ISSUED})[{TOKEN}.-]{{12,}}+{PADDING}"
    f"|(?=[^{QUOTED}]{{6}}){_named()}(?:(?<=[{QUOTE}])[^{QUOTED}]{{6,}}+(?=[{QUOTE}])"
    f"|(?<![{QUOTE}])(?=[^{BARE}0-9]*+[0-9])[^{BARE}]{{6,}}+{PADDING})"
    f"|(?<![{TOKEN}-])(?=[A-Za-z+/_-]*+[0-9])[{TOKEN}-]{{16,}}+{PADDING}"
)
#: Words that placeholders and names hold.
PLACEHOLDERS = [
    "example", "sample", "test", "dummy", "fake", "placeholder", "change", "replace", "your", "here", "insert", "todo",
    "password", "secret", "token", "key", "user", "admin", "name", "value", "data", "file", "path", "index", "page",
    "post", "http", "https", "www", "html", "image", "version", "release", "build", "node", "class", "function",
    "license", "public", "private", "default", "config", "session", "request", "response", "number", "order",
    "date", "time", "year", "the", "and", "for", "with", "this", "that", "from", "xxxx", "abcd", "1234", "0000",
]
SECRET_WORDS = r"(?i)(passw(or)?d|passwd|pwd|secret|token|api[ _-]?key|access[ _-]?key|auth|bearer|credential|private[ _-]?key)"
DIGEST_WORDS = r"(?i)\b(sha[0-9]*|md5|commit|revision|digest|checksum|hash|uuid|guid|etag|isbn|card|order|invoice|phone)\b"
ASSIGNED = r"[=:]\s*[\"']?$"
JOINED = r"^[\"'`]?\s*[=:]\s*[\"'`]?$"
TEST_PATH = r"(?i)(test|example|sample|fixture|mock|doc|vendor|lock)"
#: A word that stands alone, in lower-cased text, and the words inside a token.
WORD = f"(?<![{TOKEN}=-])[a-z]{{3,20}}+(?![{TOKEN}=-])"
INSIDE = "[A-Z]?[a-z]{2,}+|[A-Z]{3,}+"
UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"

FEATURES = [
    "length", "digits", "upper", "lower", "other", "changes", "distinct", "hexadecimal", "numeric", "uuid", "issued",
    "placeholder", "dictionary", "quoted", "assigned", "secret_word", "digest_word", "test_path", "slashes",
]
#: What labels are given by, and what findings left open lack.
EVIDENCE = ["issued", "assigned", "secret_word", "digest_word"]


def proposals(docs: DataFrame) -> DataFrame:
    """doc_id, path, and each finding with its place (code points, end
    exclusive) and the text around it."""
    path = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    hit = docs.select("doc_id", "text", path.alias("path")).filter(F.col("text").rlike(PATTERN))
    cut = once(
        hit,
        found=F.regexp_extract_all("text", F.lit(f"({PATTERN})"), F.lit(1)),
        between=F.split("text", PATTERN, -1),
    )

    def named(i):
        """The finding before, if it is the name of this one."""
        name = F.substring(F.get("found", i - 1), -NEAR, NEAR)
        return F.when((i > 0) & F.get("between", i).rlike(JOINED), name).otherwise("")

    each = F.transform(
        F.col("found"),
        lambda token, i: F.struct(
            i.alias("number"),
            token.alias("token"),
            F.substring(F.concat(named(i), F.get("between", i)), -NEAR, NEAR).alias("before"),
            F.substring(F.get("between", i + 1), 1, NEAR).alias("after"),
            F.length(F.get("between", i)).alias("gap"),
        ),
    )
    # A running sum over the findings of one text.
    placed = F.aggregate(
        each,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda so_far, x: F.struct(
            (so_far["at"] + x["gap"] + F.length(x["token"])).alias("at"),
            F.concat(so_far["starts"], F.array(so_far["at"] + x["gap"])).alias("starts"),
        ),
    )
    rows = cut.select("doc_id", "path", placed["starts"].alias("starts"), F.explode(each).alias("x"))
    start = F.get("starts", F.col("x.number")).cast("bigint")
    return rows.select(
        "doc_id",
        "path",
        start.alias("start"),
        (start + F.length("x.token")).alias("end"),
        F.col("x.token").alias("token"),
        F.col("x.before").alias("before"),
        F.col("x.after").alias("after"),
    )


def _share(pattern: str) -> Column:
    """Share of the token's characters outside ``pattern``."""
    return F.length(F.regexp_replace("token", pattern, "")) / F.length("token")


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def described(found: DataFrame) -> DataFrame:
    """``found`` with the features that it shows by itself."""
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace("token", "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0")
    changes = F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1
    plain = F.regexp_replace(F.lower("token"), "|".join(sorted(set(PLACEHOLDERS), key=lambda w: (-len(w), w))), "")
    values = {
        "length": F.least(F.length("token"), F.lit(200)).cast("double"),
        "digits": _share("[^0-9]"),
        "upper": _share("[^A-Z]"),
        "lower": _share("[^a-z]"),
        "other": _share("[A-Za-z0-9]"),
        "changes": changes / F.length("token"),
        "distinct": F.size(F.array_distinct(F.split("token", ""))).cast("double"),
        "hexadecimal": _flag(F.col("token").rlike("^[0-9a-fA-F]+$")),
        "numeric": _flag(F.col("token").rlike("^[0-9/_=+-]+$")),
        "uuid": _flag(F.col("token").rlike(UUID)),
        "issued": _flag(F.col("token").rlike(f"^(?:{ISSUED}|{HEADER})")),
        "placeholder": 1 - F.length(plain) / F.length("token"),
        "quoted": _flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")),
        "assigned": _flag(F.col("before").rlike(ASSIGNED)),
        "secret_word": _flag(F.col("before").rlike(SECRET_WORDS)),
        "digest_word": _flag(F.col("before").rlike(DIGEST_WORDS)),
        "test_path": _flag(F.col("path").rlike(TEST_PATH)),
        "slashes": F.size(F.split("token", "/")).cast("double") - 1,
    }
    return found.withColumns({f"f_{name}": value.cast("double") for name, value in values.items()})


def corpus_words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Those of the ``wanted`` words, with their other columns, that stand alone
    in ``WORD_DOCS`` documents or more; all documents are counted."""
    own = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    counted = docs.select(F.explode(own).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("docs"))
    return counted.filter(F.col("docs") >= WORD_DOCS).drop("docs").join(wanted, "word")


def covered(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``found`` with ``f_dictionary``, the share of the token in words of the corpus."""
    key = F.sha2("token", 256).alias("token_key")
    tokens = via_table(found.groupBy("token").agg(F.count(F.lit(1)).alias("n")).select(key, "token", "n"), "found-tokens")
    inside = F.transform(F.regexp_extract_all("token", F.lit(INSIDE), F.lit(0)), F.lower)
    pieces = tokens.select("token_key", F.explode(inside).alias("word")).filter(F.length("word") >= 3)
    each = via_table(pieces.groupBy("token_key", "word").agg(F.count(F.lit(1)).alias("times")), "words-in-tokens")
    wanted = each.groupBy("word").agg(F.count(F.lit(1)).alias("rows"))
    known = via_table(corpus_words(docs, wanted), "known-words")
    chars = lookup_join(each, known, "word", "rows").groupBy("token_key").agg(F.sum(F.length("word") * F.col("times")).alias("chars"))
    share = (F.coalesce("chars", F.lit(0)) / F.length("token")).alias("f_dictionary")
    shares = via_table(tokens.join(chars, "token_key", "left").select("token_key", "n", share), "dictionary-shares")
    return lookup_join(found.withColumn("token_key", key), shares, "token_key", "n").drop("token_key", "n")


def near_words() -> Column:
    """Different words around a finding, without those that give its label."""
    near = F.regexp_replace(F.concat_ws(" ", "before", "after"), f"{SECRET_WORDS}|{DIGEST_WORDS}", " ")
    return F.array_distinct(F.regexp_extract_all(F.lower(near), F.lit("[a-z]{2,}"), F.lit(0)))


def rule_label() -> Column:
    """1 and 0 for findings that are clear, null for the others."""
    on = {name: F.col(f"f_{name}") > 0 for name in FEATURES}
    placeholder = (F.col("f_placeholder") > 0.4) | (F.col("f_distinct") < 6)
    return (
        F.when(placeholder | on["numeric"] | on["uuid"], 0)
        .when(on["issued"] | (on["secret_word"] & on["assigned"] & ~on["digest_word"]), 1)
        .when(on["digest_word"], 0)
        .cast("int")
    )


def order_key() -> Column:
    return F.xxhash64("token", "before", "after", "path")


def training_rows(found: DataFrame, labels: DataFrame | None, sample_rows: int) -> DataFrame:
    """At most ``sample_rows`` different described findings with a label and how
    often they occur as weight, in the order of a hash. ``labels`` has doc_id,
    start and label."""
    if labels is None:
        rows = found.withColumn("label", rule_label())
    else:
        rows = found.join(labels.select("doc_id", "start", F.col("label").cast("int").alias("label")), ["doc_id", "start"])
    features = [f"f_{name}" for name in FEATURES]
    known = rows.filter("label IS NOT NULL").groupBy("token", "before", "after", "path", "label", *features)
    different = known.agg(F.count(F.lit(1)).cast("double").alias("weight")).withColumn("_order", order_key())
    chosen = different.orderBy("_order", "label", *features).limit(sample_rows)
    return chosen.select("label", "weight", "before", "after", *features)


def without_evidence(train: DataFrame) -> DataFrame:
    """``train``, and each row once more as it would look without its evidence."""
    return train.unionByName(train.withColumns({f"f_{name}": F.lit(0.0) for name in EVIDENCE}))


def secret_findings(docs: DataFrame, labels: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per finding: doc_id, start, end, kind, score and secret (the verdict)."""
    found = via_table(covered(via_table(described(proposals(docs)), "proposals"), docs), "findings")
    train = via_table(training_rows(found, labels, sample_rows), "labelled-findings")
    positive = F.col("label") * F.col("weight")
    state = train.agg(*(F.coalesce(F.sum(x), F.lit(0.0)).alias(k) for k, x in (("n", F.col("weight")), ("positive", positive)))).first()
    if 0 < state["positive"] < state["n"]:
        words = HashingTF(inputCol="_near", outputCol="_words", numFeatures=NEAR_WORDS, binary=True)
        features = VectorAssembler(inputCols=[*(f"f_{name}" for name in FEATURES), "_words"], outputCol="_features")
        forest = RandomForestClassifier(
            featuresCol="_features", labelCol="label", weightCol="weight", probabilityCol="_chance", rawPredictionCol="_votes",
            predictionCol="_class", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", seed=7,
        )
        rows = without_evidence(train).withColumn("_near", near_words())
        model = Pipeline(stages=[words, features, forest]).fit(rows)
        scored = model.transform(found.withColumn("_near", near_words())).withColumn("score", F.get(vector_to_array("_chance"), F.lit(1)))
    else:
        scored = found.withColumn("score", F.lit(state["positive"] / max(1, state["n"])))
    kind = F.when(F.col("f_issued") > 0, "issued").when(F.col("f_hexadecimal") > 0, "hexadecimal").otherwise("token")
    return scored.select(
        "doc_id", "start", "end", kind.alias("kind"), F.round("score", 6).alias("score"), (F.col("score") >= THRESHOLD).alias("secret")
    )


def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_findings(documents(spark, sf))
