"""Near-duplicates: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

1. One pass over the texts gives per document its number of distinct word shingles, a 128-bit fingerprint of the set and one
   key per band. One hash per shingle fills all bins (one permutation); an empty bin copies the bin that a hash sequence
   of its own finds first non-empty (optimal densification).
2. Documents with equal sets form a class; from here on only its smallest id takes part.
3. Documents that share a band key form a bucket. A bucket makes a star only: its hub is the member whose buckets are
   the largest in sum, so most buckets of a group share one hub, and every member is paired with the hub.
4. Hub pairs are confirmed on full sets. Members that link to the hub are done: they are connected through it.
5. A pair of members can be lost to the star only if at least one of the two does not link to their hub. Those members
   are compared, on full sets, with all members of the same hub, block by block inside tasks: no pair is emitted
   unless it is a link between two components, and a member gives one link per component. Jaccard distance is a metric,
   so only members whose similarities to the hub differ by 1 - threshold at most are counted as links to check.
6. Components of the confirmed links; the smallest id of a component stays.

With 252 bins in 42 bands of 6, a pair at similarity 0.85 shares no bucket with probability 2e-9, at 0.8 with 3e-6.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.common import lean, materialise, split_by_ids, utf8_array
from dockwatch.llm.components import components
from dockwatch.llm.textscan import STEP, mix, shingle_set, slices, span_hashes, words
from dockwatch.llm.tokens import ragged

BANDS, ROWS = 42, 6
#: Members compared at once in step 5.
X_BLOCK, Y_BLOCK = 128, 512
EMPTY = np.uint64(2**64 - 1)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def one_permutation(sets, bins):
    """Signatures of non-empty shingle sets, empty bins densified: one row per set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = mix(np.concatenate(sets) + _SECOND)
    owner = np.repeat(np.arange(len(sets)), sizes)
    cell = owner * bins + (((flat >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    packed = np.sort((cell.astype(np.uint64) << np.uint64(32)) | (flat & np.uint64(0xFFFFFFFF)))
    cells = (packed >> np.uint64(32)).astype(np.int64)
    first = np.ones(len(cells), bool)
    first[1:] = cells[1:] != cells[:-1]
    signature = np.full(len(sets) * bins, EMPTY)
    signature[cells[first]] = packed[first] & np.uint64(0xFFFFFFFF)
    signature = signature.reshape(len(sets), bins)
    filled = signature != EMPTY
    row, col = np.nonzero(~filled)
    attempt = 0
    while len(row):
        attempt += 1
        donor = (mix(col.astype(np.uint64) * STEP + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        found = filled[row, donor]
        signature[row[found], col[found]] = signature[row[found], donor[found]]
        row, col = row[~found], col[~found]
    return signature


def band_keys(signature, bands, rows):
    out = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b, np.uint64)
        for r in range(rows):
            key = key * STEP + mix(signature[:, b * rows + r])
        out[:, b] = mix(key)
    return out


def fingerprints(sets):
    """Two independent 64-bit sums over each set."""
    ends = np.cumsum([0] + [len(s) for s in sets])
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    sums = []
    for salt in (np.uint64(1), STEP):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(flat * np.uint64(3) + salt), dtype=np.uint64)])
        sums.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
    return sums


def batch_sets(batch, k):
    """For slices of a batch ``id, text``: the ids and the shingle sets (A-Z lower-cased)."""
    data, offsets = utf8_array(batch.column(1))
    for a, b in slices(offsets):
        part, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        starts, ends, first = words(part, at)
        hashes = span_hashes(part, starts, ends, lower=True)
        yield batch.column(0).slice(a, b - a), [shingle_set(hashes[x:y], k) for x, y in zip(first, first[1:])]


def sketch(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """``id, n, f1, f2, bands`` per row; a text without words has n = 0 and no bands."""

    def run(batches):
        for batch in batches:
            for ids, sets in batch_sets(batch, k):
                f1, f2 = fingerprints(sets)
                size = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(size)
                keys = band_keys(one_permutation([sets[i] for i in full], bands * rows), bands, rows) if len(full) else np.zeros((0, bands), np.uint64)
                ends = np.concatenate([[0], np.cumsum(np.where(size > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(size), pa.array(f1), pa.array(f2), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64)))],
                    ["id", "n", "f1", "f2", "bands"])

    return docs.mapInArrow(lean(run), "id long, n long, f1 long, f2 long, bands array<long>")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """``id, f1, f2, members``: the sorted 64-bit shingle hashes of each text as bytes."""

    def run(batches):
        for batch in batches:
            for ids, sets in batch_sets(batch, k):
                f1, f2 = fingerprints(sets)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(f1), pa.array(f2), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "f1", "f2", "members"])

    return docs.mapInArrow(lean(run), "id long, f1 long, f2 long, members binary")


def confirm(pairs: DataFrame) -> DataFrame:
    """``a, b, inter, total`` (sizes of intersection and union) of pairs that carry both sets."""

    def run(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            inter, total, last, held = [], [], None, None
            for i in range(batch.num_rows):
                x = left[i].as_buffer()
                if last is None or not x.equals(last):
                    last, held = x, np.frombuffer(x, np.uint64)
                y = np.frombuffer(right[i].as_buffer(), np.uint64)
                at = np.searchsorted(held, y)
                at[at == len(held)] = 0
                same = int((held[at] == y).sum())
                inter.append(same)
                total.append(len(held) + len(y) - same)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(inter, pa.int64()), pa.array(total, pa.int64())], ["a", "b", "inter", "total"])

    return pairs.select("a", "b", "left", "right").mapInArrow(lean(run), "a long, b long, inter long, total long")


def block_links(num: int, den: int):
    """Links of one block of not yet connected members (side 0) with one block of members of the same hub (side 1)."""

    def run(table):
        table = table.combine_chunks()
        side, ids, comps, near = (table[c].to_numpy() for c in ("side", "id", "comp", "near"))
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table["members"]]
        xs, ys = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        out = set()
        if len(xs) and len(ys):
            size = np.array([len(sets[x]) for x in xs])
            value, owner = np.concatenate([sets[x] for x in xs]), np.repeat(np.arange(len(xs)), size)
            order = np.argsort(value, kind="stable")
            value, owner = value[order], owner[order]
            margin = 1 - num / den + 1e-9
            for y in ys:
                worth = (comps[xs] != comps[y]) & (np.abs(near[xs] - near[y]) <= margin)
                if not worth.any():
                    continue
                low = np.searchsorted(value, sets[y])
                high = np.searchsorted(value, sets[y], "right")
                inter = np.bincount(owner[ragged(low, high - low)], minlength=len(xs))
                linked = worth & (den * inter >= num * (size + len(sets[y]) - inter))
                out.update((int(comps[xs[i]]), int(comps[y])) for i in np.flatnonzero(linked))
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return run


def near_duplicates(df: DataFrame, k=5, num=4, den=5, id_col="doc_id", text_col="text", bands=BANDS, rows=ROWS) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every row; linked: ``den * intersection >= num * union`` of the shingle sets.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a set holds the distinct runs of ``k`` words, fewer
    words make one shingle, and a text that is null or has no words links with nothing. ``component_id`` is the smallest id
    reachable. Rows with the same id are one document and share a component; a row with a null id is linked with nothing,
    has a null component and is kept. Other columns are ignored; an empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows_of = materialise(sketch(docs, k, bands, rows), "sketches")
    linked = rows_of.where("n > 0 and id is not null")
    key = ["f1", "f2", "n"]
    classes = materialise(linked.groupBy(*key).agg(F.min("id").alias("rep")), "classes")
    reps = linked.join(classes.withColumnRenamed("rep", "id"), ["id", *key]).dropDuplicates(["id", *key])
    reps = materialise(reps.select(F.col("id").alias("rep"), "bands"), "reps")

    # a document with several texts connects the classes of its rows
    several = linked.select("id", *key).groupBy("id").agg(F.min(F.struct(*key)).alias("lo"), F.max(F.struct(*key)).alias("hi")).where("lo <> hi").select("id")
    same_id = linked.select("id", *key).join(several, "id").join(classes, key).select(F.col("id").alias("a"), F.col("rep").alias("b"))

    spread = reps.select("rep", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").count().where("count > 1")
    members = materialise(spread.join(shared, "key").select("key", "rep", "count"), "buckets")
    weight = members.groupBy("rep").agg(F.sum("count").alias("w"))
    weighed = members.join(weight, "rep").select("key", "rep", "w")
    hubs = weighed.groupBy("key").agg(F.max(F.struct("w", (-F.col("rep")).alias("m"))).alias("hub")).select("key", (-F.col("hub.m")).alias("hub"))
    stars = materialise(members.join(hubs, "key").where("rep <> hub").select("hub", "rep").distinct(), "stars")

    nodes = materialise(stars.select(F.col("hub").alias("id")).union(stars.select(F.col("rep").alias("id"))).distinct(), "nodes")
    involved, _ = split_by_ids(docs, "id", nodes)
    sets = full_sets(involved.join(nodes, "id"), k).join(classes.select(F.col("rep").alias("id"), "f1", "f2"), ["id", "f1", "f2"])
    sets = materialise(sets.dropDuplicates(["id", "f1", "f2"]).select("id", "members"), "sets")
    pairs = (stars.join(sets.select(F.col("id").alias("rep"), F.col("members").alias("right")), "rep")
             .join(sets.select(F.col("id").alias("hub"), F.col("members").alias("left")), "hub")
             .select(F.col("hub").alias("a"), F.col("rep").alias("b"), "left", "right"))
    tested = materialise(confirm(pairs).withColumn("tight", F.expr(f"{den} * inter >= {num} * total")), "tested")
    links = tested.where("tight").select("a", "b").unionByName(same_id)
    first = components(links)

    # members that did not link to their hub, against all members of that hub
    def component_of(name):
        return first.select(F.col("id").alias(name), "component")

    seen = tested.join(component_of("b"), "b", "left").withColumn("comp", F.coalesce("component", "b")).drop("component")
    seen = seen.join(component_of("a"), "a", "left").withColumn("open", ~F.col("tight") & (F.col("comp") != F.coalesce("component", "a")))
    seen = materialise(seen.select(F.col("a").alias("hub"), F.col("b").alias("id"), "comp", (F.col("inter") / F.col("total")).alias("near"), "open"), "seen")
    sizes = seen.groupBy("hub").agg(F.count("*").alias("ys"), F.sum(F.col("open").cast("int")).alias("xs")).where("xs > 0 and ys > 1")
    sizes = sizes.select("hub", F.ceil(F.col("xs") / X_BLOCK).cast("int").alias("nx"), F.ceil(F.col("ys") / Y_BLOCK).cast("int").alias("ny"))
    dealt = seen.join(sizes, "hub").join(sets, "id")
    spot = F.xxhash64("hub", "id")
    block = "hub", "xb", "yb", "side", "id", "comp", "near", "members"
    x = dealt.where("open").withColumn("side", F.lit(0)).withColumn("xb", F.pmod(spot, "nx").cast("int")).withColumn("yb", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
    y = dealt.withColumn("side", F.lit(1)).withColumn("yb", F.pmod(spot, "ny").cast("int")).withColumn("xb", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)))
    late = x.select(*block).unionByName(y.select(*block)).groupBy("hub", "xb", "yb").applyInArrow(block_links(num, den), "a long, b long")
    joined = components(late)
    final = first.join(joined.select(F.col("id").alias("component"), F.col("component").alias("wider")), "component", "left")
    alone = joined.join(first.select("id"), "id", "left_anti").select("id", "component")  # not in any hub link
    final = final.select("id", F.coalesce("wider", "component").alias("component")).unionByName(alone)

    placed = classes.join(final.select(F.col("id").alias("rep"), "component"), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component"))
    placed = rows_of.select("id", *key).join(placed, key, "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return placed.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                         (component.isNull() | (component == F.col("id"))).alias("kept"))


def keep_one(df: DataFrame, k=5, num=4, den=5, id_col="doc_id", text_col="text") -> DataFrame:
    """One document of each group (the one with the smallest id), all columns unchanged.

    Of several rows with the same kept id one stays; rows with a null id stay. Rows are matched by id: only the ids that go,
    and the few that repeat, are joined to the texts.
    """
    found = materialise(near_duplicates(df, k, num, den, id_col, text_col), "groups")
    gone = found.where("not kept").select(F.col(id_col)).distinct()
    maybe, stay = split_by_ids(df, id_col, gone)
    left = stay.unionByName(maybe.join(gone, id_col, "left_anti").select(df.columns))
    repeated = materialise(found.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col), "repeated")
    if repeated.isEmpty():
        return left
    once = left.join(repeated, id_col, "left_semi").dropDuplicates([id_col])
    return left.join(repeated, id_col, "left_anti").unionByName(once).select(df.columns)
