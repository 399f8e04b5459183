"""The same queries as SQL for DuckDB, written from the definitions rather than from the plans.

Where the library takes a scalable route (positions and gaps, block top-k, symmetric binomial
tails), the SQL states the plain definition: rank every pair, sum every outcome.
"""

from __future__ import annotations

import re

from claimweave.config import CLASSIFIER_FAMILIES, RELEVANCE_LABELS, STANCE_LABELS
from claimweave.functions.stats import Z_95
from claimweave.functions.text import ENGLISH_STOP_WORDS, TERM_PATTERN, WHITESPACE
from claimweave.workload.queries import (
    COUNT_PARAMS,
    DIM,
    TEXT_BIAS,
    TEXT_SEARCH,
    TEXT_WEIGHTS,
    TREND_PARAMS,
    VECTOR_BIAS,
    VECTOR_SEARCH,
    VECTOR_WEIGHTS,
)

WS = "'" + WHITESPACE + "'"
STOP = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)
SEED = "42"


def strip(c: str) -> str:
    return f"trim(coalesce({c}, ''), {WS})"


def rest_of(c: str) -> str:
    return f"CASE WHEN instr({c}, chr(10)) > 0 THEN substr({c}, instr({c}, chr(10)) + 1) ELSE '' END"


def tf_of(source: str, text: str, keys: str) -> str:
    return (
        f"SELECT {keys}, term, count(*) AS tf FROM (SELECT {keys}, "
        f"unnest(regexp_extract_all(lower({text}), '{TERM_PATTERN}')) AS term FROM {source}) "
        f"WHERE term NOT IN ({STOP}) GROUP BY ALL"
    )


def draw(slot: int) -> str:
    return f"('0x' || substr(md5('{SEED}|' || query_id || '|{slot}'), 1, 15))::BIGINT"


PASSAGES = {
    "corpus": f"SELECT doc_id::VARCHAR AS doc_id, split_part(text, chr(10), 1) AS title, "
    f"{rest_of('text')} AS abstract FROM documents",
    "claims": "SELECT item_id::VARCHAR AS query_id, text AS claim FROM benchmark",
    "qrels": "SELECT CASE WHEN item_id % 4 = 0 THEN 'test' ELSE 'train' END AS split, "
    "item_id::VARCHAR AS query_id, doc_id::VARCHAR AS doc_id "
    "FROM benchmark b JOIN documents d ON contains(d.text, b.text)",
    "excluded": "SELECT DISTINCT query_id, doc_id FROM qrels",
    "asked": "SELECT DISTINCT query_id FROM qrels",
}

DIALOG = {
    "turns": "SELECT *, (conv_id * 1000 + turn)::VARCHAR AS id FROM conversations",
    "corpus": f"SELECT id AS doc_id, split_part(text, chr(10), 1) AS title, "
    f"{rest_of('text')} AS abstract FROM turns WHERE role = 'assistant'",
    "claims": "SELECT id AS query_id, text AS claim FROM turns WHERE role = 'user'",
    "qrels": "SELECT CASE WHEN q.conv_id % 4 = 0 THEN 'test' ELSE 'train' END AS split, "
    "q.id AS query_id, a.id AS doc_id FROM turns q JOIN turns a "
    "ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 "
    "WHERE q.role = 'user' AND a.role = 'assistant'",
    "excluded": PASSAGES["excluded"],
    "asked": PASSAGES["asked"],
}

STANCE = {
    **{name: PASSAGES[name] for name in ("corpus", "claims", "qrels")},
    "evidence": "SELECT split, query_id, q.doc_id, "
    "CASE WHEN quality = 1 THEN 'SUPPORTS' ELSE 'REFUTES' END AS label "
    "FROM qrels q JOIN labels l ON l.doc_id::VARCHAR = q.doc_id",
    "excluded": "SELECT DISTINCT query_id, doc_id FROM evidence",
    "asked": "SELECT DISTINCT query_id FROM evidence",
}


def index(max_features: int = 50_000) -> dict[str, str]:
    return {
        "variants": "SELECT unnest(['title', 'abstract', 'title_abstract']) AS field_variant",
        "doc_text": f"SELECT doc_id, field_variant, t, a, CASE field_variant WHEN 'title' THEN t "
        f"WHEN 'abstract' THEN a ELSE trim(t || '. ' || a, {WS}) END AS document_text "
        f"FROM (SELECT doc_id, {strip('title')} AS t, {strip('abstract')} AS a FROM corpus), variants",
        "doc_tf": tf_of("doc_text", "document_text", "doc_id, field_variant"),
        "vocab": "SELECT field_variant, term, df, ctf, "
        "ln((1.0 + (SELECT count(*) FROM corpus)) / (1.0 + df)) + 1.0 AS idf FROM ("
        "SELECT *, row_number() OVER (PARTITION BY field_variant ORDER BY ctf DESC, term) AS rn "
        "FROM (SELECT field_variant, term, count(*) AS df, sum(tf)::BIGINT AS ctf FROM doc_tf "
        f"GROUP BY ALL HAVING count(*) >= 2)) WHERE rn <= {max_features}",
        "doc_w": "SELECT doc_id, field_variant, term, tf * idf AS w "
        "FROM doc_tf JOIN vocab USING (field_variant, term)",
        "doc_norm": "SELECT doc_id, field_variant, sqrt(sum(w * w)) AS dn FROM doc_w GROUP BY ALL",
    }


SIMILARITY = {
    "claim_tf": tf_of("claims", "claim", "query_id"),
    "claim_w": "SELECT query_id, field_variant, term, tf * idf AS qw "
    "FROM claim_tf JOIN vocab USING (term)",
    "claim_norm": "SELECT query_id, field_variant, sqrt(sum(qw * qw)) AS qn FROM claim_w GROUP BY ALL",
    "sim": "SELECT field_variant, query_id, doc_id, round(sum(qw * w) / (any_value(qn) * any_value(dn)), 6) "
    "AS score FROM claim_w JOIN doc_w USING (field_variant, term) "
    "JOIN claim_norm USING (query_id, field_variant) JOIN doc_norm USING (doc_id, field_variant) "
    "GROUP BY field_variant, query_id, doc_id",
}

RANDOM = {
    "avail": "SELECT query_id, doc_id, "
    "row_number() OVER (PARTITION BY query_id ORDER BY md5(doc_id), doc_id) - 1 AS r, "
    "count(*) OVER (PARTITION BY query_id) AS m "
    "FROM (SELECT query_id, doc_id FROM asked, corpus) p WHERE NOT EXISTS ("
    "SELECT 1 FROM excluded e WHERE e.query_id = p.query_id AND e.doc_id = p.doc_id)",
    "draws": f"SELECT query_id, m, CASE WHEN m = 1 THEN 0 ELSE {draw(1)} % (m - 1) END AS d1, "
    f"{draw(2)} % m AS d2 FROM (SELECT DISTINCT query_id, m FROM avail)",
    "randoms": "SELECT query_id, doc_id FROM avail JOIN ("
    "SELECT query_id, d1 AS r FROM draws UNION ALL "
    "SELECT query_id, CASE WHEN d2 = d1 THEN m - 1 ELSE d2 END FROM draws WHERE m > 1) "
    "USING (query_id, r)",
}

HARD = {
    "hard": "SELECT field_variant, query_id, doc_id FROM (SELECT *, row_number() OVER ("
    "PARTITION BY field_variant, query_id ORDER BY score DESC, "
    "CASE WHEN score > 0 THEN doc_id END, md5(doc_id), doc_id) AS rn FROM ("
    "SELECT field_variant, query_id, doc_id, coalesce(score, 0) AS score "
    "FROM (SELECT query_id, doc_id, field_variant FROM avail, variants) "
    "LEFT JOIN sim USING (field_variant, query_id, doc_id)) s WHERE NOT EXISTS ("
    "SELECT 1 FROM randoms x WHERE x.query_id = s.query_id AND x.doc_id = s.doc_id)) WHERE rn <= 2",
}


def pair_rows(positive: str, negative: str, ids: str) -> str:
    return (
        "SELECT split, field_variant, query_id, doc_id, claim, t AS title, a AS abstract, "
        f"document_text, label, ({ids})::INTEGER AS label_id FROM ("
        f"SELECT split, query_id, doc_id, field_variant, label FROM ({positive}), variants "
        "UNION ALL SELECT split, query_id, doc_id, field_variant, label FROM ("
        f"SELECT query_id, doc_id, field_variant, '{negative}' AS label FROM randoms, variants "
        f"UNION ALL SELECT query_id, doc_id, field_variant, '{negative}' FROM hard) "
        "JOIN splits USING (query_id)) "
        "JOIN claims USING (query_id) JOIN doc_text USING (doc_id, field_variant)"
    )


RELEVANCE_ROWS = pair_rows(
    "SELECT DISTINCT split, query_id, doc_id, 'relevant' AS label FROM qrels",
    "not_relevant",
    "CASE label WHEN 'relevant' THEN 1 ELSE 0 END",
)
STANCE_ROWS = pair_rows(
    "SELECT split, query_id, doc_id, label FROM evidence",
    "NEI",
    "CASE label WHEN 'NEI' THEN 0 WHEN 'REFUTES' THEN 1 ELSE 2 END",
)


def sql(ctes: dict[str, str], final: str) -> str:
    """A statement with only the CTEs the final query reaches."""
    needed: list[str] = []

    def visit(text: str, limit: list[str]) -> None:
        for name in limit:
            if name not in needed and _mentions(text, name):
                visit(ctes[name], limit[: limit.index(name)])
                needed.append(name)

    visit(final, list(ctes))
    if not needed:
        return final
    ordered = [n for n in ctes if n in needed]
    body = ", ".join(f"{n} AS MATERIALIZED ({ctes[n]})" for n in ordered)
    return f"WITH {body} {final}"


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None


# --- vectors -----------------------------------------------------------------------------------

VECTOR_PAIRS = {
    "vp": "SELECT a.vec_id, a.embedding::DOUBLE[] AS q, b.embedding::DOUBLE[] AS d "
    "FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "pf": "SELECT vec_id, q, d, "
    f"list_transform(range(1, {DIM + 1}), lambda i: abs(q[i] - d[i])) AS diff, "
    f"list_transform(range(1, {DIM + 1}), lambda i: q[i] * d[i]) AS prod, "
    "list_dot_product(q, d) AS cosine FROM vp",
}


def logits(weights: dict, bias: list[float], vector: str) -> list[str]:
    out = []
    for cls in range(3):
        terms = [f"{w} * {vector}[{j + 1}]" for j, w in weights.get(cls, {}).items()]
        out.append(" + ".join([str(bias[cls]), *terms]))
    return out


def scored(hits: str, weights: dict, bias: list[float], vector: str) -> dict[str, str]:
    z = logits(weights, bias, vector)
    return {
        "z": f"SELECT *, {z[0]} AS z0, {z[1]} AS z1, {z[2]} AS z2 FROM {hits}",
        "p": "SELECT *, exp(z0) / (exp(z0) + exp(z1) + exp(z2)) AS p0, "
        "exp(z1) / (exp(z0) + exp(z1) + exp(z2)) AS p1, "
        "exp(z2) / (exp(z0) + exp(z1) + exp(z2)) AS p2 FROM z",
        "scored": "SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 'NEI' WHEN p1 >= p2 THEN 'REFUTES' "
        "ELSE 'SUPPORTS' END AS stance, greatest(p0, p1, p2) AS confidence, "
        "round(1 - p0, 6) AS p_stance FROM p",
    }


VECTOR_HITS = {
    "hits": "SELECT query_id, doc_id, cosine, rank, d FROM (SELECT *, row_number() OVER ("
    "PARTITION BY query_id ORDER BY cosine DESC, doc_id) AS rank FROM ("
    "SELECT a.vec_id::VARCHAR AS query_id, b.vec_id::VARCHAR AS doc_id, b.embedding::DOUBLE[] AS d, "
    "round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine "
    f"FROM embeddings a, embeddings b)) WHERE rank <= {VECTOR_SEARCH.top_k}",
    **scored("hits", VECTOR_WEIGHTS, VECTOR_BIAS, "d"),
}

VECTOR_SCORES = {**VECTOR_PAIRS, **scored("vp", VECTOR_WEIGHTS, VECTOR_BIAS, "d")}


def hashed(source: str, id_column: str, text: str, tag: str) -> dict[str, str]:
    return {
        f"{tag}_sums": f"SELECT {id_column}, ('0x' || substr(md5(term), 1, 8))::BIGINT % {DIM} AS bucket, "
        f"sum(tf * idf) AS s FROM ({tf_of(source, text, id_column)}) "
        "JOIN (SELECT term, idf FROM vocab WHERE field_variant = 'title_abstract') USING (term) "
        "GROUP BY ALL",
        f"{tag}_len": f"SELECT {id_column}, sqrt(sum(s * s)) AS n FROM {tag}_sums GROUP BY ALL",
        f"{tag}_cells": f"SELECT {id_column}, bucket, "
        "coalesce(s / n, 0)::FLOAT::DOUBLE AS v "
        f"FROM (SELECT {id_column}, unnest(range({DIM})) AS bucket FROM {source}) "
        f"LEFT JOIN {tag}_sums USING ({id_column}, bucket) LEFT JOIN {tag}_len USING ({id_column})",
        f"{tag}_vec": f"SELECT {id_column}, list(v ORDER BY bucket) AS v FROM {tag}_cells GROUP BY ALL",
    }


TEXT_VECTORS = {
    **PASSAGES,
    **index(),
    "passages": "SELECT doc_id, t, a, rtrim(document_text, '.') AS passage FROM doc_text "
    "WHERE field_variant = 'title_abstract'",
    **hashed("passages", "doc_id", "passage", "doc"),
    **hashed("claims", "query_id", "claim", "claim"),
}

TEXT_HITS = {
    **TEXT_VECTORS,
    "hits": "SELECT query_id, doc_id, cosine, d FROM (SELECT *, row_number() OVER ("
    "PARTITION BY query_id ORDER BY cosine DESC, doc_id) AS rank FROM ("
    "SELECT query_id, doc_id, d.v AS d, round(list_dot_product(c.v, d.v), 6) AS cosine "
    f"FROM claim_vec c, doc_vec d)) WHERE rank <= {TEXT_SEARCH.top_k}",
    **scored("hits", TEXT_WEIGHTS, TEXT_BIAS, "d"),
}


def counts(confidence: float) -> str:
    sure = f"confidence >= {confidence}"
    return (
        f"count(*) FILTER ({sure} AND stance = 'SUPPORTS') AS supports, "
        f"count(*) FILTER ({sure} AND stance = 'REFUTES') AS refutes, "
        f"count(*) FILTER ({sure} AND stance = 'NEI') AS nei, "
        f"count(*) FILTER (NOT {sure}) AS uncertain"
    )


# --- statistics --------------------------------------------------------------------------------


def choose(n: str, k: str) -> str:
    """C(n, k) as the product of its ratios."""
    return (
        f"list_reduce(list_prepend(1.0::DOUBLE, list_transform(range(1, least({k}, {n} - {k}) + 1), "
        f"lambda i: (({n} - least({k}, {n} - {k}) + i)::DOUBLE / i))), lambda x, y: x * y)"
    )


def two_sided(s: str, n: str, source: str, key: str) -> str:
    """Sum of all outcomes no likelier than the observed one."""
    return (
        f"SELECT {key}, least(1.0, sum(pk) FILTER (pk <= po * (1 + 1e-9))) AS p_value FROM ("
        f"SELECT {key}, {choose('n', 'k')} * pow(0.5, n) AS pk, {choose('n', 's')} * pow(0.5, n) AS po "
        f"FROM (SELECT {key}, {s} AS s, {n} AS n, unnest(range({n} + 1)) AS k FROM {source} "
        f"WHERE {n} > 0)) GROUP BY ALL"
    )


def wilson(s: str, n: str, sign: str) -> str:
    zz = Z_95 * Z_95
    return (
        f"(({s} / {n} + {zz} / (2 * {n})) {sign} {Z_95} * sqrt(({s} / {n} * (1 - {s} / {n}) "
        f"+ {zz} / (4 * {n})) / {n})) / (1 + {zz} / {n})"
    )


def directional(source: str, key: str, p) -> dict[str, str]:
    return {
        "gated": f"SELECT *, supports + refutes AS n, CASE WHEN max_cos < {p.coverage_low} "
        f"THEN 'low_coverage' WHEN supports + refutes < {p.min_stance_docs} THEN 'too_few' "
        f"ELSE 'tested' END AS test_status FROM {source}",
        "tested": "SELECT * FROM gated WHERE test_status = 'tested'",
        "pvals": two_sided("supports", "supports + refutes", "tested", key),
        "directed": f"SELECT {key}, test_status, supports / n AS support_share, "
        f"{wilson('supports', 'n', '-')} AS wilson_low, {wilson('supports', 'n', '+')} AS wilson_high, "
        f"p_value, CASE WHEN p_value < {p.alpha} AND supports > refutes THEN 'supporting' "
        f"WHEN p_value < {p.alpha} THEN 'refuting' ELSE 'none' END AS verdict "
        f"FROM tested JOIN pvals USING ({key}) UNION ALL "
        f"SELECT {key}, test_status, NULL, NULL, NULL, NULL, NULL FROM gated WHERE test_status <> 'tested'",
    }


def trend(p) -> str:
    return (
        f"CASE WHEN max_cos < {p.coverage_low} THEN 'low_coverage' "
        f"WHEN nei >= {p.nei_share * p.top_k} OR (supports + refutes) / {p.top_k} < {p.min_density} "
        "THEN 'nei_dominant' WHEN supports + refutes < 5 THEN 'too_few' "
        "WHEN supports >= 3 * refutes THEN 'strong_support' "
        "WHEN refutes >= 3 * supports THEN 'strong_refute' "
        "WHEN supports >= 2 * refutes AND supports >= 5 THEN 'support' "
        "WHEN refutes >= 2 * supports AND refutes >= 5 THEN 'refute' ELSE 'mixed' END"
    )


def coverage(p) -> str:
    return (
        f"CASE WHEN max_cos < {p.coverage_low} THEN 'none' "
        f"WHEN avg_cos < {p.coverage_ok} THEN 'limited' ELSE 'ok' END"
    )


COUNTS = {
    "cc": "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS supports, "
    "count(*) FILTER (o_orderstatus = 'O') AS refutes, count(*) FILTER (o_orderstatus = 'P') AS nei, "
    "round(avg(o_totalprice) / 450000, 6) AS avg_cos, round(max(o_totalprice) / 550000, 6) AS max_cos "
    "FROM orders GROUP BY o_custkey",
    **directional("cc", "o_custkey", COUNT_PARAMS),
}

SUMMARY = {
    **TEXT_HITS,
    "counted": f"SELECT query_id, {counts(TEXT_SEARCH.confidence)}, avg(cosine) AS avg_cos, "
    "max(cosine) AS max_cos FROM scored GROUP BY query_id",
    **directional("counted", "query_id", TEXT_SEARCH),
}

# --- metrics -----------------------------------------------------------------------------------

RULES = {
    "preds": "SELECT classifier, quality AS label_id, hit::INTEGER AS prediction_id FROM ("
    "SELECT quality, unnest([{'classifier': 'long_text', 'hit': n_chars >= 300}, "
    "{'classifier': 'longer_text', 'hit': n_chars >= 1500}, "
    "{'classifier': 'english', 'hit': lang = 'en'}], recursive := true) "
    "FROM labels JOIN documents USING (doc_id))",
    "cls": "SELECT classifier, label, id, count(*) FILTER (label_id = id) AS support, "
    "count(*) FILTER (prediction_id = id) AS predicted, "
    "count(*) FILTER (label_id = id AND prediction_id = id) AS hits FROM preds, "
    "(VALUES ('not_relevant', 0), ('relevant', 1)) v(label, id) GROUP BY ALL",
    "prf": "SELECT classifier, label, support, "
    "CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision, "
    "CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall, "
    "CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * hits / (support + predicted) END AS f1 FROM cls",
    "acc": "SELECT classifier, avg((label_id = prediction_id)::INTEGER) AS accuracy FROM preds GROUP BY ALL",
    "macro": "SELECT classifier, avg(f1) AS macro_f1 FROM prf GROUP BY ALL",
}

LABELLED = {
    "lr": "SELECT CASE WHEN doc_id % 4 = 0 THEN 'test' ELSE 'train' END AS split, "
    "CASE WHEN quality = 1 THEN 'relevant' ELSE 'not_relevant' END AS label, "
    "quality AS label_id FROM labels"
}


DIALOG_STANCE = {
    **{name: DIALOG[name] for name in ("turns", "corpus", "claims", "qrels")},
    "evidence": "SELECT split, query_id, doc_id, CASE WHEN (query_id::BIGINT // 1000) % 2 = 0 "
    "THEN 'SUPPORTS' ELSE 'REFUTES' END AS label FROM qrels",
    "excluded": STANCE["excluded"],
    "asked": STANCE["asked"],
}

# Claim lines as the binding writes them, and what becomes of each.
CLAIM_LINES = {
    **{name: STANCE[name] for name in ("qrels", "evidence")},
    "words": "SELECT query_id, doc_id, CASE WHEN doc_id::BIGINT % 11 = 0 OR doc_id::BIGINT % 5 = 0 OR doc_id::BIGINT % 7 = 0 "
    "THEN NULL WHEN label = 'SUPPORTS' THEN 'SUPPORT' ELSE 'CONTRADICT' END AS label FROM evidence",
    "lines": "SELECT CASE WHEN item_id % 4 = 0 THEN 'test' ELSE 'train' END AS split, item_id::VARCHAR AS query_id, "
    "CASE WHEN item_id % 9 = 6 THEN 'malformed' WHEN item_id % 9 = 4 THEN 'no_id' WHEN item_id % 9 = 5 THEN 'no_claim' "
    "WHEN item_id::VARCHAR NOT IN (SELECT query_id FROM words WHERE label IS NOT NULL) THEN 'no_evidence' END AS reason "
    "FROM benchmark",
}


def comparison(rows: str, labels: dict[str, int], variants: str) -> str:
    """What has to hold of every fit on the pairs ``rows``."""
    support = ", ".join(
        f"count(*) FILTER (split = 'test' AND label_id = {i}) AS support_{name.lower()}" for name, i in labels.items()
    )
    families = ", ".join(f"'{f}'" for f in CLASSIFIER_FAMILIES)
    test = "count(*) FILTER (split = 'test')"
    return (
        f"SELECT field_variant, classifier, {4 * DIM + 1}::INTEGER AS feature_dim, "
        f"count(*) FILTER (split = 'train') AS train_rows, {test} AS test_rows, true AS in_range, "
        f"{test} AS n_predictions, {test} AS n_known, {test} AS n_scored, {support} "
        f"FROM ({rows}) r, (SELECT unnest([{families}]) AS classifier) WHERE field_variant IN ({variants}) GROUP BY ALL"
    )


def oracle_sql() -> dict[str, str]:
    idx = {**PASSAGES, **index()}
    sim = {**idx, **SIMILARITY}
    pairs = {**sim, **RANDOM, **HARD, "splits": "SELECT DISTINCT split, query_id FROM qrels"}
    talk = {**DIALOG, **index(), **SIMILARITY, **RANDOM, **HARD, "splits": pairs["splits"]}
    stance = {
        **STANCE,
        **index(),
        **SIMILARITY,
        **RANDOM,
        **HARD,
        "splits": "SELECT DISTINCT split, query_id FROM evidence",
    }
    talk_stance = {**DIALOG_STANCE, **index(), **SIMILARITY, **RANDOM, **HARD, "splits": stance["splits"]}
    every_hard = {**pairs, "asked": "SELECT DISTINCT query_id FROM claims"}
    block = lambda name, i: (
        f"round(list_sum({name}), 6) AS sum_{i}, "
        f"round(list_sum(list_transform({name}, lambda x: abs(x))), 6) AS abs_{i}"
    )
    return {
        "load_qrels": sql(PASSAGES, "SELECT split, query_id, doc_id FROM qrels"),
        "vector_store_integrity": "SELECT sum(n)::BIGINT AS n_rows, "
        "count(*) FILTER (n > 1) AS n_duplicate_ids, sum(k)::BIGINT AS n_null_vectors, "
        "min(lo)::INTEGER AS min_dim, max(hi)::INTEGER AS max_dim FROM (SELECT vec_id, count(*) AS n, "
        "count(*) FILTER (embedding IS NULL) AS k, min(len(embedding)) AS lo, "
        "max(len(embedding)) AS hi FROM embeddings GROUP BY vec_id)",
        "document_text_variants": sql(
            idx,
            "SELECT doc_id, field_variant, length(document_text)::INTEGER AS n_chars, "
            "md5(document_text) AS text_md5 FROM doc_text",
        ),
        "passage_text": sql(TEXT_VECTORS, "SELECT doc_id, 'passage: ' || passage AS passage FROM passages"),
        "claim_prompts": sql(PASSAGES, f"SELECT query_id, 'query: ' || {strip('claim')} AS prompt FROM claims"),
        "stance_bodies": sql(
            PASSAGES,
            f"SELECT doc_id, md5({strip('coalesce(nullif(abstract, {e}), title)'.format(e=chr(39) * 2))}) "
            "AS body_md5 FROM corpus",
        ),
        "normalize_stance": "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'unclear' WHEN toxic = 1 THEN 'nei' "
        "WHEN quality = 1 THEN 'Support' ELSE 'contradict' END AS word, "
        "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN toxic = 1 THEN 'NEI' "
        "WHEN quality = 1 THEN 'SUPPORTS' ELSE 'REFUTES' END AS stance FROM labels",
        "label_ids": sql(
            LABELLED,
            "SELECT split, label, label_id::INTEGER AS id, label AS name, count(*) AS n_rows FROM lr GROUP BY ALL",
        ),
        "tokenize_terms": sql(
            idx, "SELECT doc_id, term, tf::INTEGER AS tf FROM doc_tf WHERE field_variant = 'title_abstract'"
        ),
        "valid_pairs": "SELECT conv_id, turn, CASE WHEN c = '' THEN 'empty_claim' "
        "WHEN t = '' AND a = '' THEN 'empty_document' ELSE 'valid' END AS status FROM ("
        f"SELECT conv_id, turn, CASE WHEN role = 'user' THEN {strip('text')} ELSE '' END AS c, "
        f"{strip('split_part(text, chr(10), 1)')} AS t, {strip(rest_of('text'))} AS a "
        "FROM conversations)",
        "abstract_excerpt": sql(
            PASSAGES,
            f"SELECT doc_id, CASE WHEN length(a) <= 200 THEN a ELSE rtrim(substr(a, 1, 197), {WS}) || '...' "
            "END AS excerpt, '[' || t || '](https://www.semanticscholar.org/paper/CorpusID:' || doc_id || ')' "
            f"AS source FROM (SELECT doc_id, {strip('title')} AS t, {strip('abstract')} AS a FROM corpus)",
        ),
        "positive_lookup": sql(PASSAGES, "SELECT query_id, doc_id FROM excluded"),
        "relevance_positives": sql(
            PASSAGES,
            "SELECT DISTINCT split, query_id, doc_id, claim, title, abstract FROM qrels "
            "JOIN claims USING (query_id) JOIN corpus USING (doc_id)",
        ),
        "stance_positives": sql(STANCE, "SELECT split, query_id, doc_id, label FROM evidence"),
        "term_statistics": sql(idx, "SELECT field_variant, term, df, ctf, round(idf, 6) AS idf FROM vocab"),
        "capped_vocabulary": sql(
            {**PASSAGES, **index(500)}, "SELECT field_variant, term, df, ctf FROM vocab"
        ),
        "tfidf_weights": sql(
            idx,
            "SELECT field_variant, doc_id, count(*) AS n_terms, round(sum(w), 4) AS weight_sum, "
            "round(sqrt(sum(w * w)), 6) AS norm FROM doc_w GROUP BY ALL",
        ),
        "tfidf_similarity": sql(
            sim,
            "SELECT field_variant, query_id, doc_id, score, rank::INTEGER AS rank FROM (SELECT *, "
            "row_number() OVER (PARTITION BY field_variant, query_id ORDER BY score DESC, doc_id) AS rank "
            "FROM sim WHERE score > 0) WHERE rank <= 20",
        ),
        "random_negatives": sql(every_hard, "SELECT query_id, doc_id FROM randoms"),
        "hard_negatives": sql(every_hard, "SELECT field_variant, query_id, doc_id FROM hard"),
        "relevance_pairs": sql(pairs, RELEVANCE_ROWS),
        "pairs_csv": sql(pairs, RELEVANCE_ROWS),
        "pairs_published": sql(pairs, RELEVANCE_ROWS),
        "pairs_republished": sql(
            pairs, f"SELECT * FROM ({RELEVANCE_ROWS}) r WHERE split = 'train' OR label = 'relevant'"
        ),
        "pairs_quality": sql(
            {
                **PASSAGES,
                "flagged": "SELECT query_id::BIGINT % 5 = 0 AS no_claim, doc_id::BIGINT % 3 = 0 AS no_doc "
                "FROM (SELECT DISTINCT split, query_id, doc_id FROM qrels)",
                "checked": f"SELECT role <> 'user' OR {strip('text')} = '' AS no_text, "
                f"{strip('text')} = '' AS empty FROM conversations",
            },
            "SELECT 'n_judged' AS measure, count(*) AS n FROM flagged UNION ALL "
            "SELECT 'n_missing_claim', count(*) FILTER (no_claim) FROM flagged UNION ALL "
            "SELECT 'n_missing_document', count(*) FILTER (no_doc) FROM flagged UNION ALL "
            "SELECT 'n_matched', count(*) FILTER (NOT no_claim AND NOT no_doc) FROM flagged UNION ALL "
            "SELECT 'n_asked', count(*) FROM checked UNION ALL "
            "SELECT 'n_empty_claim', count(*) FILTER (no_text) FROM checked UNION ALL "
            "SELECT 'n_empty_document', count(*) FILTER (NOT no_text AND empty) FROM checked",
        ),
        "classify_stream": sql(
            talk,
            "SELECT query_id || '/' || doc_id AS request_id, CASE WHEN (query_id::BIGINT // 1000) % 5 = 0 "
            f"OR {strip('claim')} = '' THEN 'empty_claim' WHEN title = '' AND abstract = '' THEN 'empty_document' "
            f"ELSE 'scored' END AS status, true AS same FROM ({RELEVANCE_ROWS}) r "
            "WHERE split = 'test' AND field_variant = 'title_abstract'",
        ),
        "recovered_confusion": sql(
            RULES, "SELECT classifier, label_id, prediction_id, count(*) AS n FROM preds GROUP BY ALL"
        ),
        "corpus_jsonl": sql(
            PASSAGES,
            f"SELECT doc_id, md5({strip('title')}) AS title_md5, md5({strip('a')}) AS abstract_md5 FROM (SELECT *, "
            "CASE WHEN doc_id::BIGINT % 2 = 0 THEN replace(abstract, chr(10), ' ') ELSE abstract END AS a FROM corpus)",
        ),
        "claims_jsonl": sql(
            CLAIM_LINES,
            "SELECT split, query_id, doc_id, label FROM lines JOIN words USING (query_id) "
            "WHERE reason IS NULL AND label IS NOT NULL",
        ),
        "rejected_claims": sql(
            CLAIM_LINES,
            "SELECT split, CASE WHEN reason IN ('no_claim', 'no_evidence') THEN query_id END AS query_id, reason, "
            """CASE WHEN reason = 'malformed' THEN '{"id": "' || query_id || '", "claim": "cut o' END AS line """
            "FROM lines WHERE reason IS NOT NULL",
        ),
        "train_compare": sql(
            talk, comparison(RELEVANCE_ROWS, RELEVANCE_LABELS, "'title', 'abstract', 'title_abstract'")
        ),
        "train_compare_stance": sql(talk_stance, comparison(STANCE_ROWS, STANCE_LABELS, "'title_abstract'")),
        "model_roundtrip": sql(
            talk_stance,
            f"SELECT query_id, doc_id, label_id, 'logistic_regression' AS classifier, {4 * DIM + 1}::INTEGER AS feature_dim, "
            f"true AS same FROM ({STANCE_ROWS}) r WHERE split = 'test' AND field_variant = 'title_abstract'",
        ),
        "evidence_search_fitted": sql(
            TEXT_HITS,
            "SELECT query_id, doc_id, round(cosine, 3) AS retrieval_cos, "
            "'[' || t || '](https://www.semanticscholar.org/paper/CorpusID:' || doc_id || ')' AS source, "
            "count(*) OVER (PARTITION BY query_id) AS n_counted, true AS sums_to_one, true AS ranked "
            "FROM hits JOIN passages USING (doc_id)",
        ),
        "relevance_pairs_dialog": sql(talk, RELEVANCE_ROWS),
        "stance_pairs": sql(stance, STANCE_ROWS),
        "confusion_matrix": sql(
            RULES, "SELECT classifier, label_id, prediction_id, count(*) AS n FROM preds GROUP BY ALL"
        ),
        "accuracy_macro_f1": sql(
            RULES,
            "SELECT classifier, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1 "
            "FROM acc JOIN macro USING (classifier)",
        ),
        "classification_report": sql(
            RULES,
            "SELECT classifier, label, round(precision, 6) AS precision, round(recall, 6) AS recall, "
            "round(f1, 6) AS f1, support FROM prf UNION ALL "
            "SELECT classifier, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), "
            "round(avg(f1), 6), sum(support)::BIGINT FROM prf GROUP BY classifier UNION ALL "
            "SELECT classifier, 'weighted avg', round(sum(precision * support) / sum(support), 6), "
            "round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), "
            "sum(support)::BIGINT FROM prf GROUP BY classifier",
        ),
        "class_balance": sql(
            LABELLED, "SELECT split, label, count(*) AS n_rows FROM lr GROUP BY ROLLUP (split, label)"
        ),
        "class_weights": sql(
            LABELLED,
            "SELECT label_id, n_rows, round((SELECT count(*) FROM lr) / "
            "((SELECT count(DISTINCT label_id) FROM lr) * n_rows), 6) AS weight "
            "FROM (SELECT label_id, count(*) AS n_rows FROM lr GROUP BY ALL)",
        ),
        "variant_summary": sql(
            {**LABELLED, "variants": index()["variants"]},
            "SELECT field_variant, count(*) FILTER (split = 'train') AS train_rows, "
            f"count(*) FILTER (split = 'test') AS test_rows, {4 * DIM + 1}::INTEGER AS feature_dim "
            "FROM lr, variants GROUP BY field_variant",
        ),
        "best_model": sql(
            RULES,
            "SELECT classifier, round(macro_f1, 6) AS macro_f1 FROM acc JOIN macro USING (classifier) "
            "ORDER BY macro.macro_f1 DESC, accuracy DESC, "
            "list_position(['long_text', 'longer_text', 'english'], classifier) LIMIT 1",
        ),
        "split_filter": sql(
            LABELLED, "SELECT label, count(*) AS n_rows FROM lr WHERE split = 'test' GROUP BY label"
        ),
        "l2_normalize": "SELECT vec_id, round(n, 5) AS norm_before, "
        "round(sqrt(list_sum(list_transform(v, lambda x: (x / n) * (x / n)))), 6) AS norm_after, "
        "round(v[1] / n, 6) AS first, round(v[-1] / n, 6) AS last FROM ("
        "SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM (SELECT vec_id, "
        "list_transform(embedding, lambda x: x::DOUBLE * (label + 2)) AS v FROM embeddings))",
        "pair_cosine": sql(VECTOR_PAIRS, "SELECT vec_id, round(list_dot_product(q, d), 6) AS cosine FROM vp"),
        "pair_features": sql(
            VECTOR_PAIRS,
            f"SELECT vec_id, {4 * DIM + 1}::INTEGER AS width, {block('q', 0)}, {block('d', 1)}, "
            f"{block('diff', 2)}, {block('prod', 3)}, round(cosine, 6) AS cosine FROM pf",
        ),
        "pair_features_concat": sql(
            VECTOR_PAIRS,
            f"SELECT vec_id, {2 * DIM}::INTEGER AS width, round(list_sum(q), 6) AS sum_q, "
            "round(list_sum(d), 6) AS sum_d FROM vp",
        ),
        "feature_moments": sql(
            {
                **VECTOR_PAIRS,
                "cells": f"SELECT unnest(range({4 * DIM + 1})) AS position, "
                "unnest(list_concat(q, d, diff, prod, [cosine])) AS x FROM pf",
            },
            "SELECT position, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM cells GROUP BY ALL",
        ),
        "hashed_embedding": sql(
            TEXT_VECTORS, "SELECT doc_id, bucket, round(v, 5) AS value FROM doc_cells"
        ),
        "encode_corpus": sql(
            TEXT_VECTORS,
            "SELECT doc_id, md5(t) AS title_md5, md5(a) AS abstract_md5, len(v)::INTEGER AS dim, "
            "round(sqrt(list_dot_product(v, v)), 4) AS norm FROM passages JOIN doc_vec USING (doc_id)",
        ),
        "cosine_retrieval": sql(
            VECTOR_HITS, "SELECT query_id, doc_id, cosine, rank::INTEGER AS rank FROM hits"
        ),
        "cosine_retrieval_bucketed": sql(
            VECTOR_HITS, "SELECT query_id, doc_id, cosine, rank::INTEGER AS rank FROM hits"
        ),
        "approximate_recall": sql(
            VECTOR_HITS,
            "SELECT count(DISTINCT query_id) AS n_claims, count(*) AS n_hits, true AS true_cosines, "
            "true AS recall_reached FROM hits WHERE query_id::BIGINT % 100 = 0",
        ),
        "retrieval_coverage": sql(
            VECTOR_HITS,
            "SELECT query_id, round(avg(cosine) + 1e-12, 6) AS avg_cos, round(max(cosine), 6) AS max_cos "
            "FROM hits GROUP BY query_id",
        ),
        "linear_stance_scores": sql(
            VECTOR_SCORES,
            "SELECT vec_id, round(p0, 6) AS p_nei, round(p1, 6) AS p_refutes, round(p2, 6) AS p_supports, "
            "stance, round(confidence, 6) AS confidence FROM scored",
        ),
        "stance_counts": sql(
            VECTOR_HITS, f"SELECT query_id, {counts(VECTOR_SEARCH.confidence)} FROM scored GROUP BY query_id"
        ),
        "stance_rerank": sql(
            VECTOR_HITS,
            "SELECT query_id, r::INTEGER AS rank, doc_id, p_stance, cosine FROM (SELECT *, row_number() OVER ("
            "PARTITION BY query_id ORDER BY p_stance DESC, cosine DESC, doc_id) AS r FROM scored) "
            f"WHERE r <= {VECTOR_SEARCH.top_n}",
        ),
        "evidence_search": sql(
            {**SUMMARY, "maxima": "SELECT query_id, max(cosine) AS max_cos FROM hits GROUP BY query_id"},
            "SELECT query_id, r::INTEGER AS rank, doc_id, stance, round(p2, 3) AS p_supports, "
            "round(p1, 3) AS p_refutes, round(p0, 3) AS p_nei, round(cosine, 3) AS retrieval_cos, "
            f"(stance <> 'NEI' AND confidence >= {TEXT_SEARCH.confidence} "
            f"AND max_cos >= {TEXT_SEARCH.coverage_low}) AS used_in_test, "
            "'[' || t || '](https://www.semanticscholar.org/paper/CorpusID:' || doc_id || ')' AS source, "
            f"CASE WHEN length(a) <= 200 THEN a ELSE rtrim(substr(a, 1, 197), {WS}) || '...' END "
            "AS abstract_excerpt FROM (SELECT *, row_number() OVER (PARTITION BY query_id "
            "ORDER BY p_stance DESC, cosine DESC, doc_id) AS r FROM scored) "
            "JOIN maxima USING (query_id) JOIN passages USING (doc_id) "
            f"WHERE r <= {TEXT_SEARCH.top_n}",
        ),
        "evidence_summary": sql(
            SUMMARY,
            "SELECT query_id, supports, refutes, nei, uncertain, round(avg_cos + 1e-12, 6) AS avg_cos, "
            f"round(max_cos + 1e-12, 6) AS max_cos, {coverage(TEXT_SEARCH)} AS coverage, test_status, "
            "round(support_share + 1e-12, 6) AS support_share, round(wilson_low + 1e-12, 6) AS wilson_low, "
            "round(wilson_high + 1e-12, 6) AS wilson_high, round(p_value + 1e-12, 6) AS p_value, verdict, "
            f"{trend(TEXT_SEARCH)} AS trend FROM counted JOIN directed USING (query_id)",
        ),
        "binomial_test": sql(
            {
                **COUNTS,
                "pv": two_sided("supports", "supports + refutes", "cc", "o_custkey"),
            },
            "SELECT o_custkey, supports, supports + refutes AS n, round(p_value + 1e-12, 9) AS p_value "
            "FROM cc LEFT JOIN pv USING (o_custkey)",
        ),
        "wilson_interval": sql(
            COUNTS,
            "SELECT o_custkey, "
            f"CASE WHEN n > 0 THEN round({wilson('supports', 'n', '-')} + 1e-12, 9) END AS wilson_low, "
            f"CASE WHEN n > 0 THEN round({wilson('supports', 'n', '+')} + 1e-12, 9) END AS wilson_high FROM gated",
        ),
        "directional_test": sql(
            COUNTS,
            "SELECT o_custkey, test_status, round(support_share + 1e-12, 6) AS support_share, "
            "round(wilson_low + 1e-12, 6) AS wilson_low, round(wilson_high + 1e-12, 6) AS wilson_high, "
            "round(p_value + 1e-12, 6) AS p_value, verdict FROM directed",
        ),
        "coverage_class": sql(COUNTS, f"SELECT o_custkey, {coverage(COUNT_PARAMS)} AS coverage FROM cc"),
        "evidence_trend": sql(COUNTS, f"SELECT o_custkey, {trend(TREND_PARAMS)} AS trend FROM cc"),
    }
