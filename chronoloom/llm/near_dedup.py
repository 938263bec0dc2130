"""Near-duplicates by a chosen-path set similarity join, confirmed on full shingle sets.

A document's set holds the 64-bit hashes of its k-word windows. Documents of equal sets are one class, joined before
anything else. Classes then go down random trees: a node picks one or two of the T min-wise values (1 / threshold on
average), and each picked value leads the documents that share it to a child. Two sets of similarity s share a picked
value with probability s, so similar ones stay together, while others part after a level or two. Nodes of at most
LEAF members are leaves; larger ones branch on, down to DEPTH levels, where nodes of any size are leaves. TREES trees
repeat this; they share the T values, so they are not quite independent: a pair at the threshold that only the deepest
leaves hold is missed about once in 400 times (simulated), all others less. Tests measure it on a group near the threshold.

Leaves are compared so that no link is lost and no group's pairs are all made: members are first confirmed against
their leaf's smallest member; after components over these links, a leaf whose members are one component is done, and
elsewhere members outside the smallest member's component are compared with all members of other components. In leaves
of over SMALL members, pairs whose min-wise values agree in less than `percent` - SLACK per cent are passed over (at the
threshold that is three standard deviations); those leaves are dealt in blocks of BLOCK members, whatever their size,
and each member's BEST likeliest pairs in a block come first, then, after components, all that still part groups. Of these
only pairs leave a block whose sets, held as SKETCH 32-bit hashes at most, come within a per cent of the threshold (five,
over five standard deviations, where a set has more hashes), since a large group of versions has nearly all its pairs short of it.

Defined results: a text without words, or null, has an empty set and stands alone; with fewer words than k the whole
sequence is the one shingle; repeated rows and equal texts are one component, named by the smallest id; rows of one id
and different sets are in classes of their own; a row without an id stands alone and is kept; an
empty table gives an empty result; extra columns are not looked at. Very long texts are hashed whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.hashing import BYTE_BACK, BYTE_STEP, WORD_BACK, WORD_STEP, Sums, bounds, mixed, per_worker, slim_batches, windows, words
from chronoloom.llm.tables import components, stored

VALUES, TREES, DEPTH, SMALL, LEAF, SLACK, BLOCK, BEST, SKETCH = 64, 12, 6, 40, 160, 15, 256, 3, 2048


def _sums():
    return per_worker("sums", lambda: (Sums(BYTE_STEP, BYTE_BACK), Sums(WORD_STEP, WORD_BACK)))


def shingle_sets(column, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    of_bytes, of_words = _sums()
    hashes, row, *_ = words(column, lower=True, sums=of_bytes)
    grams, at = windows(hashes, row, k, of_words)
    n = len(column)
    w, g = bounds(row, n), bounds(row[at], n)
    return [np.unique(grams[g[i] : g[i + 1]]) if g[i] < g[i + 1] else of_words(hashes, w[i : i + 1], w[i + 1 : i + 2]) if w[i] < w[i + 1] else grams[:0] for i in range(n)]


def set_keys(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole set."""
    return int(mixed(s).sum()) - 2**63, int((mixed(s ^ np.uint64(0x5555)) * mixed(s)).sum()) - 2**63


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """docs (doc_id, text, text_hash) to (doc_id, text_hash, n_shingles, key_1, key_2, least): the size, two hashes of the whole set, and the upper halves of its
    min-wise values."""

    def made(parts):
        steps = mixed(np.arange(1, VALUES + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in parts:
            sets = shingle_sets(batch.column(1), k)
            least = np.zeros((len(sets), VALUES), np.uint64)
            full = [i for i, s in enumerate(sets) if len(s)]
            if full:
                flat = np.concatenate([sets[i] for i in full])
                start = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
                for j, step in enumerate(steps):
                    least[full, j] = np.minimum.reduceat(flat * step, start)
            keys = [set_keys(s) for s in sets]
            upper = (least >> np.uint64(32)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([x[0] for x in keys], pa.int64()), pa.array([x[1] for x in keys], pa.int64()), pa.array([x.tobytes() for x in upper], pa.binary())], names=["doc_id", "text_hash", "n_shingles", "key_1", "key_2", "least"])

    return docs.mapInArrow(made, "doc_id long, text_hash long, n_shingles long, key_1 long, key_2 long, least binary")


def branched(nodes: DataFrame, levels: int, chance: float, trees: int = 0) -> DataFrame:
    """(node, id) after `levels` more picks, from rows (id, least, nodes: where the id is). With trees, the input has no
    nodes, and each row starts at all roots."""

    def down(parts):
        for batch in parts:
            least = np.frombuffer(b"".join(x.as_py() for x in batch.column(batch.schema.get_field_index("least"))), np.uint32).reshape(-1, VALUES)
            ids = np.asarray(batch.column(batch.schema.get_field_index("id")))
            at = np.arange(len(ids))
            if trees:
                node = np.repeat(mixed(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(WORD_STEP)), len(ids))
                at = np.tile(at, trees)
            else:
                held = batch.column(batch.schema.get_field_index("nodes"))
                node, at = np.asarray(held.flatten()).astype(np.int64).view(np.uint64), np.repeat(at, held.value_lengths())
            for _ in range(levels):
                pick = mixed(node ^ np.uint64(0xA5A5))
                first, second = pick % np.uint64(VALUES), (pick >> np.uint64(16)) % np.uint64(VALUES)
                twice = ((pick >> np.uint64(40)) & np.uint64(0xFFFF)) < chance * 65536
                node, at, coordinate = np.concatenate([node, node[twice]]), np.concatenate([at, at[twice]]), np.concatenate([first, second[twice]])
                node = mixed(node * np.uint64(BYTE_STEP) + mixed(coordinate << np.uint64(32) | least[at, coordinate.astype(np.int64)].astype(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(ids[at])], names=["node", "id"])

    return nodes.mapInArrow(down, "node long, id long")


def leaves(classes: DataFrame, threshold: float) -> DataFrame:
    """(node, id, members, lead): leaf members, the leaf's size and its smallest member; stored. classes: (id, least)."""
    chance, out, depth, levels = 1 / threshold - 1, None, 2, []
    level = branched(classes, 2, chance, TREES)
    while True:
        size = level.groupBy("node").agg(F.count("*").alias("members"), F.min("id").alias("lead")).filter("members > 1")
        level = stored(level.join(size, "node").distinct())
        levels.append(level)
        last = depth >= DEPTH
        leaf = level.filter(f"members <= {LEAF}" if not last else "true")
        out = leaf if out is None else out.unionByName(leaf)
        if last or level.filter(f"members > {LEAF}").isEmpty():
            return stored(out, *levels)
        # An id meets its values once, whatever the number of nodes (a few for each tree) that it is in.
        held = level.filter(f"members > {LEAF}").groupBy("id").agg(F.collect_list("node").alias("nodes"))
        level, depth = branched(held.join(classes, "id"), 2, chance), depth + 2


def sketches(sets: DataFrame) -> DataFrame:
    """(id, sketch): the upper halves of the SKETCH smallest hashes of a set."""

    def made(parts):
        for batch in parts:
            upper = [(np.frombuffer(x.as_py(), np.uint64)[:SKETCH] >> np.uint64(32)).astype(np.uint32) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in upper], pa.binary())], names=["id", "sketch"])

    return sets.select("id", "hashes").mapInArrow(made, "id long, sketch binary")


def near_enough(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether sets with these sketches may be linked: sketches of whole sets are compared whole, others by the smallest
    hashes of both."""
    whole = max(len(x), len(y)) < SKETCH
    both, either = np.intersect1d(x, y), np.union1d(x, y)
    if not whole:
        either = either[:SKETCH]
        both = both[: np.searchsorted(both, either[-1], side="right")]
    return 100 * len(both) >= (percent - (1 if whole else 5)) * len(either)


def alike(member: DataFrame, classes: DataFrame, percent: int, best: int | None = None, sets: DataFrame | None = None) -> DataFrame:
    """(a, b): in each node, members outside the lead's group paired with members of other groups, if enough of their
    min-wise values agree; with best, only so many of each member's likeliest in a block. Blocks of both sides meet, so
    that a task holds two blocks at a time. With sets, only pairs whose sketches are near enough, each in the first node that
    both are in. member: (node, id, c, lead_c)."""
    outside = F.col("c") != F.col("lead_c")
    sized = member.groupBy("node").agg(F.ceil(F.count_if(outside) / BLOCK).cast("int").alias("blocks_x"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks_y"))
    # An id meets its min-wise values and its sketch once, whatever the number of nodes that it is in.
    at, more = ["node", "c", "lead_c", "blocks_x", "blocks_y"], []
    own = member.join(sized, "node").groupBy("id").agg(F.collect_list(F.struct(*at)).alias("at")).join(classes, "id")
    if sets is not None:
        own, more = own.join(sketches(sets), "id").withColumn("nodes", F.array_distinct("at.node")), ["nodes", "sketch"]
    dealt = own.select("id", "least", *more, F.inline("at"))
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = dealt.filter(outside).withColumn("i", block("blocks_x")).select("node", "i", every("blocks_y").alias("j"), F.lit(True).alias("out"), "id", "c", "least", *more)
    y = dealt.withColumn("j", block("blocks_y")).select("node", every("blocks_x").alias("i"), "j", F.lit(False).alias("out"), "id", "c", "least", *more)

    def compared(table):
        ids, c = table.column("id").to_numpy(), table.column("c").to_numpy()
        out = table.column("out").to_numpy(zero_copy_only=False)
        least = np.frombuffer(b"".join(v.as_py() for v in table.column("least")), np.uint32).reshape(-1, VALUES)
        others, found = np.flatnonzero(~out), []
        if more:
            node, nodes = table.column("node")[0].as_py(), [set(v) for v in table.column("nodes").to_pylist()]
            sketch = [np.frombuffer(v.as_py(), np.uint32) for v in table.column("sketch")]
        for i in np.flatnonzero(out):
            agree = (least[others] == least[i]).sum(1)
            agree[c[others] == c[i]] = -1
            near = np.flatnonzero(100 * agree >= (percent - SLACK) * VALUES)
            near = others[near if best is None else near[np.argsort(-agree[near], kind="stable")[:best]]]
            if more:
                near = np.array([j for j in near if min(nodes[i] & nodes[j]) == node and near_enough(sketch[i], sketch[j], percent)], np.int64)
            found.append((np.full(len(near), ids[i]), ids[near]))
        p, q = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        return pa.table({"a": np.minimum(p, q), "b": np.maximum(p, q)})

    return x.unionByName(y).groupBy("node", "i", "j").applyInArrow(compared, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those with 100 * intersection >= percent * union."""

    def checked(parts):
        for batch in parts:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y)) if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) else 0
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    of_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("y")), "b")
    return of_b.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("x")), "a").select("a", "b", "x", "y").mapInArrow(checked, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable over links), n_class (rows of equal sets),
    text_hash (by which rows of one id are told apart) and kept (doc_id is the component's). Links join
    sets with 100 * intersection >= percent * union."""
    spark = docs.sparkSession
    slim_batches(spark)
    slim = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text", f"xxhash64(`{text_col}`) as text_hash")
    rows = stored(signatures(slim, k))
    # A class goes by a hash of its set; its smallest document stands for it.
    group = stored(rows.filter("n_shingles > 0 and doc_id is not null").groupBy(F.col("key_1").alias("id"), "key_2").agg(F.min("doc_id").alias("doc"), F.count("*").alias("n_class"), F.first("least").alias("least")))
    classes = group.select("id", "least")
    leaf = leaves(classes, percent / 100)

    def sets_of(parts):
        for batch in parts:
            sets = shingle_sets(batch.column(1), k)
            yield pa.RecordBatch.from_arrays([pa.array([set_keys(s)[0] for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "hashes"])

    needed = leaf.select("id").distinct().join(group.select("id", F.col("doc").alias("doc_id")), "id").select("doc_id").distinct()
    sets = stored(slim.select("doc_id", "text").join(needed, "doc_id").mapInArrow(sets_of, "id long, hashes binary"))

    to_lead = leaf.filter("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = stored(confirmed(to_lead, sets, percent))
    found = stored(components(links))

    def grouped(member):
        """The rows of leaves that hold other groups than their lead's."""
        named = member.select("node", "id", "members", "lead").join(found, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
        lead = found.select(F.col("id").alias("lead"), F.col("component").alias("lead_c"))
        named = named.join(lead, "lead", "left").withColumn("lead_c", F.coalesce("lead_c", "lead"))
        return stored(named.join(named.filter("c <> lead_c").select("node").distinct(), "node", "left_semi"), member)

    # In large leaves the likeliest pairs come first: once they have joined groups, few others are left to confirm.
    member = grouped(leaf)
    likely = alike(member.filter(F.col("members") > SMALL), classes, percent, BEST).distinct()
    links = stored(links.unionByName(confirmed(likely, sets, percent)), links)
    found = stored(components(links), found)
    member = grouped(member)
    few = member.filter(F.col("members") <= SMALL)
    outside = few.filter("c <> lead_c").select("node", F.col("id").alias("a"), F.col("c").alias("c_a"))
    others = few.filter("id <> lead").select("node", F.col("id").alias("b"), F.col("c").alias("c_b"))
    rest = outside.join(others, "node").filter("c_a <> c_b and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = rest.unionByName(alike(member.filter(F.col("members") > SMALL), classes, percent, sets=sets)).distinct()
    links = stored(links.unionByName(confirmed(rest, sets, percent)), links, sets)
    found = stored(components(links), found, links, member)
    named = stored(group.select("id", "key_2", "doc", "n_class").join(found, "id", "left").withColumn("component", F.coalesce("component", "id")), group)
    first = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = named.join(first, "component").select(F.col("id").alias("key_1"), "key_2", "n_class", "component_id")
    out = rows.drop("least").join(named, ["key_1", "key_2"], "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    out = out.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(alone, F.lit(1)).otherwise(F.col("n_class")).cast("long").alias("n_class"), "text_hash")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
