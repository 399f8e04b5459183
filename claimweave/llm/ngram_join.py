"""Similarity join of texts on word n-grams, with prefix filters under several global orders."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import (
    WordHashes, connected_components, drop_rows, mix64, row_mark, shingle_hashes, small, stage,
)

# Tokens in more sets than this come last in every order; at most so many are known as such.
# Any order is right: these two only shorten the lists that prefixes meet in.
FREQUENT = 64
FREQUENT_TOKENS = 200_000
HUB_ROUNDS = 1


@dataclass(frozen=True)
class JoinParams:
    """Sets of ``width`` words in a row link when 100 * intersection >= ``percent`` * union."""

    width: int = 5
    percent: int = 80

    def overlap(self, n):
        """Tokens that a set of ``n`` shares with any partner, at least."""
        return -(-self.percent * n // 100)

    def surplus(self, n):
        """How many tokens beyond one the longer prefix of the count filter adds and asks for."""
        return n // 25

    def prefix(self, n):
        return n - self.overlap(n) + 1


def token_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Distinct 64-bit tokens of a text in order of value: its word n-grams, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.unique(shingle_hashes(hashes.of(words), width).view(np.int64))


def _sets(docs: DataFrame, params: JoinParams, whole: bool) -> DataFrame:
    """``(doc_id, mark, n, key, tokens)``: the size, a 128-bit digest and the first or all tokens of each set."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_hexdigest

        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                size, key, tokens = [], [], []
                for text in part.column("text"):
                    found = token_set(text.as_py(), params.width, hashes)
                    size.append(len(found))
                    key.append(xxh3_128_hexdigest(found.tobytes()))
                    tokens.append(found if whole else found[: params.prefix(len(found)) + params.surplus(len(found))])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "mark": part.column("mark"),
                        "n": pa.array(size, pa.int64()),
                        "key": pa.array(key, pa.string()),
                        "tokens": pa.array(tokens, pa.list_(pa.int64())),
                    }
                )

    return docs.mapInArrow(read, "doc_id long, mark long, n long, key string, tokens array<long>")


def _prefixes(sets: DataFrame, frequent: list[int], params: JoinParams) -> DataFrame:
    """``(node, n, common, p1, p2, p3)``: the set's prefixes under three orders of all tokens.

    Every order puts frequent tokens last and is otherwise a different hash. ``common`` is the
    share of frequent tokens.
    """
    held = sets.sparkSession.sparkContext.broadcast(np.array(sorted(frequent), np.int64))

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            columns: dict[str, list] = {"common": [], "p1": [], "p2": [], "p3": []}
            for tokens in batch.column("tokens"):
                tokens = tokens.values.to_numpy()
                n = len(tokens)
                late = np.zeros(n, bool)
                if len(known):
                    late = known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens
                columns["common"].append(float(late.mean()))
                for k in (1, 2, 3):
                    rank = (mix64(tokens.view(np.uint64), k) >> np.uint64(1)) | (late.astype(np.uint64) << np.uint64(63))
                    columns[f"p{k}"].append(tokens[np.argsort(rank, kind="stable")[: params.prefix(n)]])
            yield pa.RecordBatch.from_pydict(
                {"node": batch.column("node"), "n": batch.column("n"), "common": pa.array(columns["common"], pa.float64())}
                | {p: pa.array(columns[p], pa.list_(pa.int64())) for p in ("p1", "p2", "p3")}
            )

    longs = ", ".join(f"p{k} array<long>" for k in (1, 2, 3))
    return sets.select("node", "n", "tokens").mapInArrow(order, f"node long, n long, common double, {longs}")


def _of(frame: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of ``frame`` whose node is in ``pairs``, which is staged."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return frame.join(small(ids, 2 * pairs.count()), "node", "left_semi")


def _verified(pairs: DataFrame, prefixes: DataFrame, sets: DataFrame, params: JoinParams) -> DataFrame:
    """The ``(ca, cb)`` of the ``pairs`` that link: the other orders' filters first, then the whole sets."""
    held = _of(prefixes, pairs).select("node", "p2", "p3")
    for side in ("a", "b"):
        pairs = pairs.join(held.select(F.col("node").alias(side), F.col("p2").alias(f"{side}2"), F.col("p3").alias(f"{side}3")), side)
    both = [F.arrays_overlap(F.slice(f"a{k}", 1, "a_most"), F.slice(f"b{k}", 1, "b_most")) for k in (2, 3)]
    pairs = stage(pairs.where(both[0] & both[1]).select("a", "b", "ca", "cb"), "join-candidates")
    held = _of(sets, pairs)
    for side in ("a", "b"):
        pairs = pairs.join(held.select(F.col("node").alias(side), F.col("tokens").alias(f"{side}t")), side)
    shared = F.size(F.array_intersect("at", "bt"))
    union = F.size("at") + F.size("bt") - shared
    return pairs.where(shared * 100 >= union * params.percent).select("ca", "cb").distinct()


def _met(sets: DataFrame, params: JoinParams, part: int = 1) -> tuple[DataFrame, list[int]]:
    """``(node, n, own)`` of the sets that can have a partner at all, and the frequent tokens.

    ``own`` counts the tokens of a set that no other has, among those whose value ``part``
    divides. What two sets share is at most the rest of either, so a set with too many of its
    own has no link.
    """
    looked_at = F.filter("tokens", lambda t: t % part == 0) if part > 1 else F.col("tokens")
    counts = sets.select("node", F.explode(looked_at).alias("token")).groupBy("token").agg(
        F.count("*").alias("count"), F.min("node").alias("node")
    )
    lone = F.when(F.col("count") == 1, F.col("node"))
    often = F.when(F.col("count") > FREQUENT, F.col("token"))
    told = counts.select(lone.alias("node"), often.alias("token"), "count").where("node is not null or token is not null")
    told = stage(told.groupBy("node", "token").agg(F.count("*").alias("own"), F.max("count").alias("count")), "join-told")
    frequent = told.where("token is not null").orderBy(F.col("count").desc(), "token").limit(FREQUENT_TOKENS)
    own = told.where("node is not null").select("node", "own")
    met = sets.select("node", F.size("tokens").cast("long").alias("n")).join(own, "node", "left").fillna(0, ["own"])
    return met.where((F.col("n") - F.col("own")) * 100 >= F.col("n") * params.percent), [r.token for r in frequent.collect()]


def _members(rows: DataFrame, params: JoinParams) -> DataFrame:
    """``(doc_id, mark, n, class)`` of the rows ``(doc_id, mark, text)``; ``class`` is a number, null without tokens."""
    first = stage(_sets(rows, params, whole=False).withColumn("row", F.monotonically_increasing_id()), "join-sets")
    filled = first.where("n > 0")
    lead = F.min(F.struct("row", "doc_id", "mark"))
    classes = filled.groupBy("key").agg(lead.alias("lead"), F.count("*").alias("copies"))
    classes = stage(classes.select("key", F.col("lead.row").alias("node"), "lead.doc_id", "lead.mark", "copies"), "join-classes")

    several = classes.where("copies > 1").select("key", "node")
    copies = stage(filled.select("row", "key").join(several, "key").where("row <> node").select("row"), "join-copies")
    nodes = filled.join(small(copies, copies.count()), "row", "left_anti")
    spread = nodes.select(F.col("row").alias("node"), F.explode("tokens").alias("token"))
    lone = spread.groupBy("token").agg(F.count("*").alias("count"), F.min("node").alias("node")).where("count = 1")
    lone = lone.groupBy("node").agg(F.count("*").alias("lone"))
    fewest = F.expr(f"(({params.percent} * n + 99) div 100) div 25 + 1")
    told = nodes.select(F.col("row").alias("node"), "doc_id", "mark", "n", F.size("tokens").alias("told")).join(lone, "node", "left")
    alive = told.where(F.col("told") - F.coalesce("lone", F.lit(0)) >= fewest).select("node", "doc_id", "mark")
    alive = stage(alive, "join-alive")

    # Found again by id and text: the row that stands for a set, and copies of it with the same id.
    wanted = alive.select("node", F.col("doc_id").alias("again"), F.col("mark").alias("held"))
    same = F.col("doc_id").eqNullSafe(F.col("again")) & (F.col("mark") == F.col("held"))
    found = rows.join(small(wanted, alive.count()), same).select("doc_id", F.col("node").alias("mark"), "text")
    sets = stage(_sets(found, params, whole=True).select(F.col("mark").alias("node"), "tokens"), "join-whole")
    if sets.count() > alive.count():  # rows with equal id and text
        sets = stage(sets.dropDuplicates(["node"]), "join-whole")
    for part in (4, 1):  # a quarter of the tokens tells most sets without a partner
        met, frequent = _met(sets, params, part)
        met = stage(met, "join-met")
        sets = sets.join(small(met.select("node"), met.count()), "node", "left_semi")
    sets = stage(sets, "join-left")
    prefixes = stage(_prefixes(sets.join(met, "node"), frequent, params).join(met.select("node", "own"), "node"), "join-prefixes")

    # A list is the sets with one token in their prefix, each with the component it is in so far.
    lists = prefixes.select("node", F.col("node").alias("component"), "n", "own", "common", F.posexplode("p1").alias("at", "token"))
    places = alive.select("node", F.col("node").alias("class"))
    for turn in range(HUB_ROUNDS + 1):
        rank = -F.col("common") if turn == 0 else F.xxhash64("node", F.lit(turn)).cast("double")
        hub = F.min(F.struct(rank, F.col("node"), F.col("component"), F.col("n"), F.col("own"), F.col("at")))
        split = lists.groupBy("token").agg(
            hub.alias("hub"), F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("many")
        )
        split = split.where("lo < hi").select(
            "token", "many", *[F.col(f"hub.{c}").alias(f"b_{c}") for c in ("node", "component", "n", "own", "at")]
        )
        lists = stage(lists.join(split, "token"), "join-lists")
        if lists.isEmpty():  # every list is in one component
            break
        pairs = stage(_candidates(lists, params, hubs=turn < HUB_ROUNDS), "join-pairs")
        lists = lists.select("node", "component", "n", "own", "common", "at", "token")
        links = stage(_verified(pairs, prefixes, sets, params), "join-links")
        if links.isEmpty():
            continue
        # Components of components: only what the new links touch is looked at.
        moved = connected_components(links, "ca", "cb", name="join-components")
        moved = moved.select(F.col("node").alias("from"), F.col("component").alias("to"))
        lists = lists.join(moved, F.col("component") == F.col("from"), "left")
        lists = lists.withColumn("component", F.coalesce("to", "component")).drop("from", "to")
        places = places.join(moved, F.col("class") == F.col("from"), "left").select("node", F.coalesce("to", "class").alias("class"))

    named = classes.select("key", "node").join(places, "node", "left").select("key", F.coalesce("class", "node").alias("class"))
    members = filled.select("doc_id", "mark", "n", "key").join(named, "key").select("doc_id", "mark", "n", "class")
    return members.unionByName(first.where("n = 0").select("doc_id", "mark", "n", F.lit(None).cast("long").alias("class")))


# Members of a list that meet all others of it in one task.
SALTED = 512


def _candidates(lists: DataFrame, params: JoinParams, hubs: bool) -> DataFrame:
    """``(a, b, ca, cb, a_most, b_most)``: members of a list in different components that may link.

    With ``hubs`` each member meets the hub of its list, else every other one; a long list is then
    dealt in parts of ``SALTED``, each of which meets all of the list.
    """
    if not hubs:
        own = ["token", "node", "component", "n", "own", "at"]
        parts = F.ceil(F.col("many") / SALTED).cast("int")
        left = lists.select(*own, F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"))
        other = [F.col(c).alias(f"b_{c}") for c in own[1:]]
        right = lists.select("token", *other, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        lists = left.join(right, ["token", "part"]).where("node < b_node")
    pairs = lists.where(F.col("component") != F.col("b_component"))
    # What the two must share, can share beside their own tokens, and can share from the first
    # common token on: a pair that links passes in the list of that token.
    need = F.expr(f"((n + b_n) * {params.percent} + {99 + params.percent}) div {100 + params.percent}")
    can = F.least(F.col("n") - F.col("own"), F.col("b_n") - F.col("b_own"))
    a_most, b_most = F.col("n") - need + 1, F.col("b_n") - need + 1
    pairs = pairs.where((can >= need) & (F.col("at") < a_most) & (F.col("b_at") < b_most))
    return pairs.select(
        F.col("node").alias("a"), F.col("b_node").alias("b"), F.col("component").alias("ca"), F.col("b_component").alias("cb"),
        a_most.cast("int").alias("a_most"), b_most.cast("int").alias("b_most"),
    ).distinct()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), row_mark(text_col).alias("mark"), F.col(text_col).alias("text"))


def jaccard_classes(
    docs: DataFrame, params: JoinParams = JoinParams(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row: its class under links of similar sets.

    1. One scan turns each text into its token set; equal sets become one node, so copies are
       linked without being paired. Kept of each set are its size, digest and first tokens.
    2. A set shares most of its tokens with any partner, so among its first tokens (in order of
       hash) a known number must occur in another set's. Sets that fall short have no link.
    3. The texts of the rest are read again for their whole sets. Sets with too many tokens that
       no other has are out, first by a quarter of the tokens, then by all. Each of the rest gets
       its prefix under three global orders, in which frequent tokens come last; a pair
       is a candidate if it meets in the first and overlaps in the second and third, and is then
       verified exactly.
    4. Links only have to connect, so members of a prefix list are first paired with one hub of
       the list, the set with most frequent tokens (``HUB_ROUNDS`` times, with another hub each). A
       family of near copies, all in the same lists, is connected by that at a cost linear in its
       size. Lists within one component are done; of all others every pair that is still in
       different components is tried, so no link between components is lost.

    Words are what stands between spaces and the controls from tab to carriage return. A text
    with fewer words than ``width`` is one token; null texts and texts without words have none,
    link with nothing and are their own class. ``component_id`` is the smallest id reachable;
    nulls count last. Tokens are 64-bit hashes, set digests 128-bit. Rows may repeat; an empty
    table gives an empty result; other columns are ignored.
    """
    members = stage(_members(_rows(docs, id_col, text_col), params), "join-members")
    smallest = members.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    linked = members.join(smallest, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    bare = members.where("class is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(bare)


def drop_similar(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """``docs`` with one row of each class of similar texts: the one with the smallest id, a null one last.

    Rows are told apart by id and text, so ids may be null or repeat; of rows equal in both one
    stays. Rows without words are in no class and stay.
    """
    members = stage(_members(_rows(docs, "doc_id", "text"), params).where("class is not null"), "similar-members")
    best = members.groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")).alias("best"), F.count("*").alias("size")
    )
    texts = members.join(best.where("size > 1"), "class").groupBy("doc_id", "mark", "best").agg(F.count("*").alias("rows"))
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("mark") == F.col("best.mark"))
    gone = texts.where(~stays | (F.col("rows") > 1)).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_gone"), stays.alias("_one"))
    return drop_rows(docs, stage(gone, "similar-gone"))
