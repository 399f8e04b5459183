"""Column expressions on text: trimming, document variants, tokens, display strings."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.config import FIELD_VARIANTS

# The characters stripped from both ends of every text (Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A term is two or more letters, digits or underscores.
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Role prefixes of asymmetric encoders.
QUERY_PREFIX = "query: "
PASSAGE_PREFIX = "passage: "

# English stop words as terms (Spark ML's default list; entries with an
# apostrophe can never equal a term and are left out).
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now cannot could
    ought would
    """.split()
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Null-safe trim: missing becomes the empty string."""
    return F.trim(F.coalesce(_col(c), F.lit("")), F.lit(WHITESPACE))


def document_text(title: Column | str, abstract: Column | str, variant: Column | str) -> Column:
    """The text a pair shows for ``variant``; ``variant`` is a column or one of the names.

    An empty title still contributes its separator (``". abstract"``). Any other variant name
    fails the job.
    """
    title, abstract = clean(title), clean(abstract)
    if isinstance(variant, str) and variant in FIELD_VARIANTS:
        variant = F.lit(variant)
    variant = _col(variant)
    return (
        F.when(variant == "title", title)
        .when(variant == "abstract", abstract)
        .when(
            variant == "title_abstract",
            F.trim(F.concat(title, F.lit(". "), abstract), F.lit(WHITESPACE)),
        )
        .otherwise(F.raise_error(F.concat(F.lit("unknown field variant: "), variant)))
    )


def stance_abstract(text: Column | str, abstract: Column | str) -> Column:
    """The body of a stance document: ``text`` if it has one, else ``abstract``."""
    return F.coalesce(F.nullif(_col(text), F.lit("")), _col(abstract), F.lit(""))


def passage_text(title: Column | str, abstract: Column | str) -> Column:
    """Text for corpus encoding: title and abstract without trailing periods."""
    return F.rtrim(document_text(title, abstract, "title_abstract"), F.lit("."))


def with_variants(df: DataFrame, variants: Iterable[str] = FIELD_VARIANTS) -> DataFrame:
    """Every row once per field variant."""
    return df.select("*", F.explode(F.array(*[F.lit(v) for v in variants])).alias("field_variant"))


def as_query(c: Column | str) -> Column:
    return F.concat(F.lit(QUERY_PREFIX), _col(c))


def as_passage(c: Column | str) -> Column:
    return F.concat(F.lit(PASSAGE_PREFIX), _col(c))


def terms_of(c: Column | str) -> Column:
    """Lower-cased terms in text order, stop words included."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TERM_PATTERN), F.lit(0))


def without_stop_words(tokens: str, stop_words: Iterable[str] | None = None) -> Column:
    """The array column named ``tokens`` without stop words.

    Written as one SQL expression: the list becomes a single hash set in the plan instead of
    one Python call per word.
    """
    words = list(ENGLISH_STOP_WORDS if stop_words is None else stop_words)
    if not words:
        return F.col(tokens)
    quoted = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)
    return F.expr(f"filter(`{tokens}`, t -> t NOT IN ({quoted}))")


def tokenize(
    df: DataFrame, texts: dict[str, Column | str], stop_words: Iterable[str] | None = None
) -> DataFrame:
    """Add one array of terms without stop words per entry ``{output: text}``."""
    df = df.withColumns({out: terms_of(c) for out, c in texts.items()})
    return df.withColumns({out: without_stop_words(out, stop_words) for out in texts})


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, wherever the optimizer moves it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_terms(tokens: Column | str) -> Column:
    """``array<struct<term, tf>>`` of a token array.

    Sorting the array and reading off its run lengths keeps the count inside the row: the
    corpus is not exploded and shuffled only to get term frequencies.
    """

    def run_starts(terms: Column) -> Column:
        positions = F.sequence(F.lit(0), F.size(terms) - 1)
        first = lambda i: (i == 0) | (F.get(terms, i) != F.get(terms, i - 1))
        return F.when(F.size(terms) > 0, F.filter(positions, first)).otherwise(
            F.array().cast("array<int>")
        )

    def runs(terms: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, i: F.struct(
                F.get(terms, start).alias("term"),
                (F.coalesce(F.get(starts, i + 1), F.size(terms)) - start).alias("tf"),
            ),
        )

    return _let(
        F.sort_array(_col(tokens)),
        lambda terms: _let(run_starts(terms), lambda starts: runs(terms, starts)),
    )


def abstract_excerpt(c: Column | str, limit: int = 200) -> Column:
    """``c`` if it is at most ``limit`` characters, else its head with an ellipsis."""
    c = _col(c)
    head = F.rtrim(F.substring(c, 1, limit - 3), F.lit(WHITESPACE))
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(head, F.lit("...")))


def source_link(title: Column | str, doc_id: Column | str, base_url: str) -> Column:
    """Markdown link from a title to the document's page."""
    return F.concat(
        F.lit("["), clean(title), F.lit("]("), F.lit(base_url), _col(doc_id), F.lit(")")
    )


def invalid_reason(claim: Column | str, title: Column | str, abstract: Column | str) -> Column:
    """Why a pair cannot be classified, null when it can."""
    return F.when(clean(claim) == "", F.lit("empty_claim")).when(
        (clean(title) == "") & (clean(abstract) == ""), F.lit("empty_document")
    )
