"""Secrets in documents: candidate strings, told from false positives by a random forest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.common import stage, text_or_empty

# Candidates: what is assigned to a secret word, from six characters of any kind; keys with a known
# prefix; and at least 16 characters of the alphabets of keys, a digit or capital among them.
# A mark, put in front of assigned values, keeps them together where a text is split into words.
MARK = "\uFDD0"
VALUE = r"[^\x20\x09-\x0D\"'`<>\uFDD0]{5,}[^\x20\x09-\x0D\"'`<>\uFDD0.,;:)\]}]"
# How keys of common services begin, and what follows.
KEYS = {
    "(?:AKIA|ASIA)": "[A-Z0-9]{12,}", "gh[pousr]_": "[A-Za-z0-9]{12,}", "[sr]k_": "[A-Za-z0-9_]{12,}",
    "xox[a-z]-": r"[A-Za-z0-9\-]{10,}", "AIza": r"[A-Za-z0-9_\-]{12,}",
}
PREFIXED = "(?<![A-Za-z0-9])(?:" + "|".join(a + b for a, b in KEYS.items()) + ")"
# A run is looked at once, from its first character on, whatever its length.
RUN = r"(?<![A-Za-z0-9+/_\-])(?=[a-z+/_\-]*+[A-Z0-9])[A-Za-z0-9+/_\-]{16,}+={0,2}"
LOOSE = rf"{PREFIXED}|{RUN}"
CANDIDATE = rf"{MARK}{VALUE}|{LOOSE}"
SEPARATOR = r"[\x20\x09-\x0D]"
CONTEXT_WORDS = 3

# Words that speak for a secret or against one in the neighbourhood, and parts of ordinary
# strings. Fixed lists.
SECRET_WORDS = "token password passwd pwd secret apikey api_key access_key key auth bearer credential private".split()
PLAIN_WORDS = "commit sha sha1 sha256 sha512 md5 checksum digest hash etag integrity uuid guid revision rev blob build version id file path image data example sample test order invoice".split()
ASSIGNED = r"(?i)((?:" + "|".join(SECRET_WORDS) + r")[\"'`]?[\x20\x09-\x0D]{0,8}(?::=|=>|[=:])[\x20\x09-\x0D]{0,8}[\"'`]?)(?=" + VALUE.replace("{5,}", "{5,}?") + ")"
DICTIONARY = (
    "the and for with this that from have not are was were will tion ing ment able over under user name file path test "
    "data info code main home page index value order model class table image example sample version config service"
).split()


@dataclass(frozen=True)
class SecretParams:
    """``findings``: rows of the labelled table the forest is trained on, a fixed bound."""

    findings: int = 4000
    trees: int = 20
    depth: int = 8
    threshold: float = 0.5
    seed: int = 3


def _length(c: Column) -> Column:
    """Characters of a text without its marks."""
    return F.length(F.translate(c, MARK, ""))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, end, value, left, right)``: every candidate with the words around it.

    ``left`` holds the up to ``CONTEXT_WORDS`` words before the candidate and what stands in
    front of it within its own word; offsets are in code points, the end exclusive.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.translate(text, MARK, "\uFFFD").alias("_text"))
    hit = rows.where(F.col("_text").rlike(LOOSE) | F.col("_text").rlike(ASSIGNED))
    hit = hit.withColumn("_text", F.regexp_replace("_text", ASSIGNED, "$1" + MARK))
    words = hit.withColumn("_words", F.split("_text", SEPARATOR))
    places = F.filter(F.sequence(F.lit(1), F.size("_words")), lambda i: F.element_at("_words", i.cast("int")).rlike(CANDIDATE))
    # Each separator is one character, so a word starts after the lengths before it and one each.
    starts = F.aggregate(
        F.col("_words"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("kept")),
        lambda acc, w: F.struct(
            (acc["at"] + _length(w) + 1).alias("at"),
            F.when(w.rlike(CANDIDATE), F.concat(acc["kept"], F.array(acc["at"]))).otherwise(acc["kept"]).alias("kept"),
        ),
        lambda acc: acc["kept"],
    )
    found = words.select("doc_id", "_words", F.explode(F.arrays_zip(places.alias("i"), starts.alias("at"))).alias("_p"))
    i = F.col("_p.i").cast("int")
    around = found.select(
        "doc_id",
        F.col("_p.at").alias("_at"),
        F.element_at("_words", i).alias("_word"),
        F.array_join(F.filter(F.slice("_words", F.greatest(i - 8, F.lit(1)), F.least(i - 1, F.lit(8))), lambda w: w != ""), " ").alias("_before"),
        F.array_join(F.slice("_words", i + 1, CONTEXT_WORDS), " ").alias("right"),
    )
    # A word may hold several candidates: each with the text of the word in front of it.
    parts = around.withColumn("_values", F.regexp_extract_all("_word", F.lit(f"({CANDIDATE})"), 1))
    each = parts.select("*", F.posexplode("_values").alias("_k", "value")).withColumn(
        "_head", F.array_join(F.slice(F.split("_word", CANDIDATE), 1, F.col("_k") + 1), "")
    )
    skipped = F.aggregate(F.slice("_values", 1, F.col("_k")), F.lit(0), lambda n, v: n + _length(v))
    start = F.col("_at") + _length(F.col("_head")) + skipped
    lead = F.array_join(F.slice(F.reverse(F.split("_before", " ")), 1, CONTEXT_WORDS), " ")
    return each.select(
        "doc_id",
        start.cast("long").alias("start"),
        (start + _length(F.col("value"))).cast("long").alias("end"),
        F.translate("value", MARK, "").alias("value"),
        F.translate(F.concat_ws(" ", lead, "_head"), MARK, "").alias("left"),
        F.translate("right", MARK, "").alias("right"),
    )


FEATURES = (
    "length", "digits", "uppers", "lowers", "others", "hex", "changes", "distinct", "dictionary", "slashes", "dashes",
    "secret_near", "plain_near", "assigned", "path_near", "repeats", "prefix_key",
)


def features(found: DataFrame) -> DataFrame:
    """``found`` with the columns ``FEATURES``: length, alphabet and its changes, dictionary cover, path and neighbours."""
    value, size = F.col("value"), F.length("value")

    def share(pattern: str) -> Column:
        return (size - F.length(F.regexp_replace(value, pattern, ""))) / size

    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[A-Z]+", "U"), "[a-z]+", "l"), "[0-9]+", "d")
    letters = F.split(value, "")
    near = F.lower(F.concat_ws(" ", "left", "right"))

    def mentions(words: list[str], where: Column) -> Column:
        return where.rlike(r"(^|[^a-z0-9_])(" + "|".join(words) + r")($|[^a-z0-9])").cast("double")

    out = {
        "length": size,
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "lowers": share("[a-z]"),
        "others": share("[^A-Za-z0-9]"),
        "hex": share("[0-9a-f]"),
        "changes": F.length(kinds) / size,
        "distinct": F.size(F.array_distinct(letters)) / F.least(size, F.lit(40)),
        "dictionary": share("(?i)" + "|".join(DICTIONARY)),
        "slashes": size - F.length(F.regexp_replace(value, "/", "")),
        "dashes": size - F.length(F.regexp_replace(value, "[-_]", "")),
        "secret_near": mentions(SECRET_WORDS, near),
        "plain_near": mentions(PLAIN_WORDS, near),
        "assigned": F.col("left").rlike(r"[=:]\s*[\"']?\s*$").cast("double"),
        "path_near": F.col("left").rlike(r"[./\\]$").cast("double"),
        "repeats": share(r"(.)\1+"),
        "prefix_key": value.rlike("^(" + "|".join(KEYS) + ")").cast("double"),
    }
    return found.withColumns({k: c.cast("double") for k, c in out.items()})


def labelled_findings(spark: SparkSession, rows: int = SecretParams().findings) -> DataFrame:
    """``(value, left, right, label)``: labelled findings made by rule, the same on every run.

    Keys and tokens of common services are secrets (1); digests, commits, identifiers, paths,
    encoded images, card and serial numbers and placeholders are not (0). The alternating
    contexts also give secrets without a telling word and false positives beside one.
    """
    n = F.col("id")
    hexes = F.sha2(F.concat(F.lit("finding"), n.cast("string")), 512)
    base = F.regexp_replace(F.base64(F.unhex(hexes)), "[^A-Za-z0-9]", "x")
    upper = F.upper(base)

    def cut(c: Column, size: int) -> Column:
        return F.substring(c, 1, size)

    number = F.substring(F.translate(hexes, "abcdef", "012345"), 1, 40)
    lower = F.translate(hexes, "0123456789", "rstuvwxyzg")
    capital = F.upper(cut(lower, 1))
    letters = F.translate(base, "0123456789", "QwErTyUiOp")

    def word(at: int) -> Column:
        words = [w for w in DICTIONARY if len(w) > 3] + "required default enter reset expired because everything password string".split()
        return F.element_at(F.array(*[F.lit(w) for w in words]), ((F.ascii(F.substring(hexes, at, 1)) * 7 + F.ascii(F.substring(hexes, at + 1, 1))) % len(words) + 1).cast("int"))

    titled = [F.initcap(word(k)) for k in (3, 7, 11, 15)]
    kinds = [  # value, left, right, label
        (F.concat(F.lit("AKIA"), cut(upper, 16)), F.lit("the"), F.lit("and then"), 1),
        (cut(hexes, 40), F.lit('= token "'), F.lit("of the"), 1),
        (cut(hexes, 18), F.lit("a to password="), F.lit("was in"), 1),
        (F.concat(F.lit("ghp_"), cut(base, 36)), F.lit("use"), F.lit("for it"), 1),
        (F.concat(F.lit("sk_live_"), cut(base, 24)), F.lit("stripe key:"), F.lit("here"), 1),
        (cut(base, 40), F.lit("aws secret access_key ="), F.lit(""), 1),
        (cut(hexes, 32), F.lit('= api_key "'), F.lit("in"), 1),
        (cut(hexes, 40), F.lit("is commit"), F.lit("on main"), 0),
        (cut(hexes, 64), F.lit("sha256:"), F.lit("file"), 0),
        (cut(hexes, 32), F.lit("md5 checksum ="), F.lit("of the file"), 0),
        (F.regexp_replace(cut(hexes, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit("id"), F.lit("was"), 0),
        (F.concat(F.lit("/home/user/data/version"), cut(number, 2), F.lit("/file"), cut(number, 3)), F.lit("path"), F.lit("is"), 0),
        (cut(number, 16), F.lit("card"), F.lit("paid"), 0),
        (cut(number, 16), F.lit("the"), F.lit("and"), 0),
        (cut(number, 16), F.lit('token = "'), F.lit("password="), 0),
        (cut(hexes, 40), F.lit('token = "'), F.lit("of id file"), 1),
        (cut(hexes, 18), F.lit("password="), F.lit("id"), 1),
        (F.concat(F.lit("AKIA"), cut(upper, 16)), F.lit("commit"), F.lit("id"), 1),
        (F.concat(F.lit("iVBORw0KGgo"), cut(base, 60)), F.lit("image data:image/png;base64,"), F.lit(""), 0),
        (F.concat(F.lit("test_model_class_"), cut(number, 4)), F.lit("in"), F.lit("the"), 0),
        (F.concat(F.lit("xxxxxxxxxxxxxxxx"), cut(number, 1)), F.lit("password="), F.lit("example"), 0),
        (F.concat(F.lit("example-token-value-"), cut(number, 3)), F.lit("= token"), F.lit("sample"), 0),
        (F.concat(F.lit("integration"), cut(number, 1), F.lit("service-name-index")), F.lit("the"), F.lit("of"), 0),
        (F.concat(F.lit("20"), cut(number, 2), F.lit("-01-01-order-page-"), cut(number, 4)), F.lit("see"), F.lit("page"), 0),
        # Keys of letters only, short passwords and those of other signs.
        (F.concat(F.lit("AKIA"), cut(F.upper(letters), 16)), F.lit("the"), F.lit("and then"), 1),
        (F.concat(F.lit("AKIA"), cut(F.upper(letters), 16)), F.lit("commit"), F.lit("id"), 1),
        (F.concat(F.lit("ghp_"), cut(letters, 36)), F.lit("use"), F.lit("for it"), 1),
        (cut(letters, 40), F.lit("aws secret access_key ="), F.lit(""), 1),
        (cut(letters, 24), F.lit("api_key="), F.lit("in"), 1),
        (F.concat(capital, F.substring(lower, 2, 5), cut(number, 1), F.substring(lower, 8, 1)), F.lit("a password="), F.lit("was in"), 1),
        (F.concat(capital, F.substring(lower, 2, 5), cut(number, 1), F.substring(lower, 8, 1)), F.lit("the password:"), F.lit("of the"), 1),
        (F.concat(F.initcap(word(3)), cut(number, 2), F.lit("!")), F.lit("pwd ="), F.lit("in"), 1),
        (F.concat(cut(base, 5), F.lit("#"), F.substring(base, 6, 4)), F.lit("passwd: \""), F.lit(""), 1),
        (F.concat(capital, F.lit("@"), F.substring(lower, 2, 3), cut(number, 1), F.substring(lower, 8, 2), F.lit("!"), F.substring(number, 2, 4), F.lit("."), F.substring(lower, 12, 3)), F.lit("a password="), F.lit("for the"), 1),
        (F.concat(F.substring(lower, 2, 6), cut(number, 3)), F.lit("secret="), F.lit("and"), 1),
        # Words, names, calls and addresses beside such words or not.
        (F.concat(word(3), F.lit("ly")), F.lit("the password:"), F.lit("of the"), 0),
        (F.concat(word(3), word(7)), F.lit("the key ="), F.lit("and"), 0),
        (F.concat(word(3), F.lit("-"), word(7)), F.lit("a token:"), F.lit("is"), 0),
        (F.initcap(F.concat(word(3), F.lit("s"))), F.lit("secret:"), F.lit("you will"), 0),
        (F.concat(F.lit("get"), *titled[:2], F.lit("()")), F.lit("token ="), F.lit("of"), 0),
        (F.concat(word(3), F.lit("."), word(7), F.lit("_"), word(11)), F.lit("self password="), F.lit("and"), 0),
        (F.concat(F.lit("https://www."), word(3), F.lit(".com/"), word(7)), F.lit("key:"), F.lit("see"), 0),
        (F.lit("********"), F.lit("password="), F.lit(""), 0),
        (F.concat(F.lit("$"), F.lit("{"), F.upper(word(3)), F.lit("_KEY}")), F.lit("api_key="), F.lit("in"), 0),
        (F.concat(*titled), F.lit("the"), F.lit("of"), 0),
        (F.concat(*titled), F.lit("class"), F.lit("and key"), 0),
        (F.upper(F.concat_ws("_", word(3), word(7), word(11), word(15))), F.lit("set"), F.lit("to"), 0),
        (F.concat_ws("/", *titled, word(19)), F.lit("the"), F.lit("or"), 0),
        (F.concat_ws("-", *titled), F.lit("an"), F.lit("of"), 0),
    ]
    kind = F.array(
        *[F.struct(v.alias("value"), a.alias("left"), b.alias("right"), F.lit(float(y)).alias("label")) for v, a, b, y in kinds]
    )
    picked = F.element_at(kind, (n % len(kinds) + 1).cast("int"))
    return spark.range(0, rows, 1, 2).select(picked.alias("f")).select("f.*")


def fit_secrets(labelled: DataFrame, params: SecretParams = SecretParams()) -> PipelineModel:
    """A forest on the features of labelled findings ``(value, left, right, label)``."""
    ready = stage(features(labelled).select("label", *FEATURES), "secret-findings")
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_x")
    forest = RandomForestClassifier(
        featuresCol="_x", labelCol="label", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_predicted",
        numTrees=params.trees, maxDepth=params.depth, seed=params.seed,
    ).fit(vector.transform(ready))
    return PipelineModel([vector, forest])


def find_secrets(
    docs: DataFrame, model: PipelineModel | None = None, params: SecretParams = SecretParams(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, start, end, value, score, secret)``: every candidate and whether the forest keeps it.

    Built-in functions and the JVM forest only; documents are scanned in place, without a
    shuffle. A text of any length gives one row per candidate. Null and empty texts have
    none; rows may repeat; an empty table gives an empty result; other columns are ignored.
    """
    model = model or fit_secrets(labelled_findings(docs.sparkSession, params.findings), params)
    scored = model.transform(features(candidates(docs, id_col, text_col)))
    score = vector_to_array("_probability")[1]
    return scored.select("doc_id", "start", "end", "value", score.alias("score"), (score >= params.threshold).alias("secret"))
