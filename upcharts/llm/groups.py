"""Links between classes that share buckets, confirmed inside groups of bounded size.

A bucket is led by its least class. All pairs of a bucket lie in the group of its leader,
and buckets with one leader make one group, so a class is sent once per leader and not
once per bucket. The work has two rounds:

1. Each class goes to the group of its least leader only. Links there are confirmed on
   whole shingle sets, and components are formed.
2. Groups that still hold several components are compared again, now with all their
   members, but only across components: a pair inside one cannot change the result.

Inside a group a class is compared with all classes outside its component, and a link
joins the two at once; what has grown into the largest component is not compared any
further. Only the links that join components are returned, so a group of m classes
makes at most m - 1 rows (a group cut into blocks: for each two blocks), never its pairs.

A group is cut by its shingles into blocks of about ``BLOCK`` of them, and a task holds
two blocks, whatever the size of the group.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.llm.components import components
from upcharts.llm.prefilter import marked
from upcharts.llm.ship import in_tasks
from upcharts.llm.text import NULL_ID, mix, run_hashes, text_slices, words_of
from upcharts.session import materialise

#: shingles of a block; every class counts as 64 more
BLOCK = 1 << 19
#: a set is known by two 64-bit sums over its shingles and their number
SAME = ["one", "two", "n"]

#: of a member i and others j of a group, those j that may still link with i
Filter = Callable[[int, np.ndarray], np.ndarray]


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text (fewer words: the whole sequence as one)."""
    for _, _, data, offsets in text_slices(column):
        words = words_of(data, offsets, lower=True)
        runs = run_hashes(words.hashes, shingle)
        bounds = words.bounds.tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            n = b - a
            if n >= shingle:
                yield np.unique(runs[a : b - shingle + 1])
            elif n:
                # a seed of their own keeps short sequences apart from shingles
                yield run_hashes(words.hashes[a:b], n, seed=100 + n)
            else:
                yield np.empty(0, np.uint64)


def digest(values: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """Two sums that tell sets apart."""
    return np.add.reduce(mix(values), dtype=np.uint64), np.add.reduce(mix(values ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)


def as_lists(rows: list[np.ndarray]) -> pa.Array:
    """A list column of 64-bit values, one list for each array."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def in_common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many values each of the ``others`` shares with ``one``; all sorted, none empty."""
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, joined), len(one) - 1)
    begins = np.concatenate(([0], np.cumsum([len(o) for o in others])[:-1]))
    return np.add.reduceat((one[at] == joined).astype(np.int64), begins)


def spanning_links(sets: list[np.ndarray], label: np.ndarray, part: np.ndarray, may_link: Filter, percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that join the components of a group; ``label`` numbers those it begins with."""
    n = np.array([len(s) for s in sets], np.int64)
    label, done, links = label.copy(), np.zeros(len(sets), bool), []
    two_parts = part.min() != part.max()
    while True:
        waiting = np.flatnonzero(~done & (label != np.bincount(label).argmax()))
        if not len(waiting):
            return links
        i = int(waiting[0])
        done[i] = True
        other = ~done & (label != label[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
        # between two blocks only pairs across them: the others meet in their own block
        if two_parts:
            other &= part != part[i]
        j = np.flatnonzero(other)
        j = may_link(i, j) if len(j) else j
        if not len(j):
            continue
        both = in_common(sets[i], [sets[k] for k in j])
        for k in j[100 * both >= percent * (n[i] + n[j] - both)].tolist():
            if label[k] != label[i]:
                links.append((i, k))
                label[label == label[k]] = label[i]


def _confirm(shingle: int, percent: int, filter_of: Callable[[pa.StructArray, list[np.ndarray], int], Filter]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for row in range(batch.num_rows):
                members = batch.column("members").slice(row, 1).flatten()
                rep = members.field("rep").to_numpy()
                label = np.unique(members.field("comp").to_numpy(), return_inverse=True)[1]
                sets = list(shingle_sets(members.field("text"), shingle))
                may_link = filter_of(members, sets, batch.column("kind")[row].as_py())
                for i, j in spanning_links(sets, label, members.field("part").to_numpy(), may_link, percent):
                    us.append(max(rep[i], rep[j]))
                    vs.append(min(rep[i], rep[j]))
            yield pa.record_batch({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return run


def _confirmed(groups: DataFrame, classes: DataFrame, shingle: int, percent: int, filter_of) -> DataFrame:
    """Links inside groups (kind, leader, rep, comp); ``classes`` has rep, n, text and what ``filter_of`` reads."""
    key = ["kind", "leader"]
    sized = groups.join(classes.select("rep", "n"), "rep")
    # most groups are one block
    large = sized.groupBy(*key).agg(F.sum(F.col("n") + 64).alias("weight")).where(F.col("weight") > BLOCK)
    large = large.select(*key, F.ceil(F.col("weight") / BLOCK).cast("int").alias("blocks"))
    dealt = sized.drop("n").join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.hash("rep"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    payload = [c for c in classes.columns if c not in ("rep", "n")]
    block = [*key, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")]
    members = F.collect_list(F.struct("rep", "comp", "part", *payload)).alias("members")
    blocks = dealt.join(classes.drop("n"), "rep").groupBy(*block).agg(members).where(F.size("members") > 1)
    return in_tasks(blocks.select("kind", "members"), _confirm(shingle, percent, filter_of), "u long, v long")


def group_links(members: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, percent: int, filter_of) -> DataFrame:
    """Links (u, v) that connect whatever classes of a bucket are linked, directly or by others.

    ``members`` has kind, bucket and rep; kinds are groups of buckets that ``filter_of``
    tells apart. ``classes`` has rep, n, _id, _check (a row that holds the set) and
    further columns for ``filter_of``; ``texts`` has _id, _check and text.
    """
    buckets = members.groupBy("kind", "bucket").agg(F.count("*").alias("size"), F.min("rep").alias("leader")).where("size > 1").drop("size")
    pairs = members.join(buckets, ["kind", "bucket"]).where("rep != leader").select("kind", "leader", "rep")
    pairs = materialise(pairs.distinct(), "led_classes")
    used = pairs.select("rep").union(pairs.select("leader")).distinct()
    wanted = materialise(classes.join(used, "rep", "left_semi"), "wanted_classes")
    # most texts belong to no class of a bucket; they are not shuffled
    maybe = marked(texts, wanted, ["_id", "_check"]).where("_maybe").drop("_maybe")
    held = wanted.join(maybe, ["_id", "_check"]).dropDuplicates(["rep"]).drop("_id", "_check")
    held = materialise(held, "classes_in_buckets")

    def with_leaders(some: DataFrame) -> DataFrame:
        return some.union(some.select("kind", "leader", F.col("leader").alias("rep"))).distinct()

    least = pairs.groupBy("rep").agg(F.min(F.struct("kind", "leader")).alias("at")).select("at.kind", "at.leader", "rep")
    first = materialise(_confirmed(with_leaders(least).withColumn("comp", F.col("rep")), held, shingle, percent, filter_of), "first_links")
    stars = materialise(components(first), "first_components")
    grown = stars.withColumnRenamed("node", "rep")
    placed = with_leaders(pairs).join(grown, "rep", "left").select("kind", "leader", "rep", F.coalesce("component", "rep").alias("comp"))
    placed = materialise(placed, "placed_in_groups")
    mixed = placed.groupBy("kind", "leader").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    rest = placed.join(mixed.select("kind", "leader"), ["kind", "leader"], "left_semi")
    more = materialise(_confirmed(rest, held, shingle, percent, filter_of), "more_links")
    # each class with its component says the same as the first links, and is soon contracted again
    return stars.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more)


def set_classes(sketches: DataFrame, carried: list[str]) -> DataFrame:
    """Documents with equal sets as one class: rep, one, two, n, first (_id, _check) and the carried columns."""
    classes = sketches.where("n > 0").groupBy(*SAME).agg(
        F.min(F.struct("_id", "_check")).alias("first"), *[F.first(c).alias(c) for c in carried]
    )
    # numbers hold once they are stored
    return materialise(classes.withColumn("rep", F.monotonically_increasing_id()), "set_classes")


def labelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    """For each class the least row (_id, _check) of its component."""
    final = components(links).withColumnRenamed("node", "rep")
    placed = materialise(classes.select(*SAME, "rep", "first").join(final, "rep", "left"), "placed_classes")
    placed = placed.withColumn("component", F.coalesce("component", "rep"))
    # most components are a class alone
    least = placed.groupBy("component").agg(F.min("first").alias("least"))
    return placed.join(least, "component").select(*SAME, "least")


def document_groups(sketches: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id of its component).

    Rows that share a doc_id count as one node, null doc_ids too.
    """
    rows = sketches.select("_id", *SAME)
    sets = rows.where("n > 0").distinct()
    repeated = sets.groupBy("_id").agg(F.count("*").alias("sets")).where("sets > 1").select("_id")
    held = materialise(sets.join(repeated, "_id", "left_semi").join(classes.select(*SAME, "rep"), SAME).select("_id", "rep"), "repeated_ids")
    hubs = held.groupBy("_id").agg(F.min("rep").alias("v"))
    links = links.union(held.join(hubs, "_id").where("rep != v").select(F.col("rep").alias("u"), "v"))

    named = materialise(labelled(classes, links).select(*SAME, F.col("least._id").alias("component")), "labelled_classes")
    worded = rows.where("n > 0").join(named, SAME).select("_id", "n", "component")
    # a wordless row goes with the others of its doc_id
    wordless = rows.where("n = 0").select("_id", "n")
    others = worded.join(wordless.select("_id").distinct(), "_id", "left_semi").groupBy("_id").agg(F.min("component").alias("component"))
    result = worded.union(wordless.join(others, "_id", "left").select("_id", "n", F.coalesce("component", "_id")))
    id_of = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return result.select(id_of("_id").alias("doc_id"), F.col("n").alias("n_shingles"), id_of("component").alias("component_id"))
