"""Near-duplicates by fast similarity sketching, banding and exact verification.

1. A task hashes the five-word shingles of whole texts and sketches each set: in round i every shingle is thrown
   into one of ``T`` bins with value i + (a hash in [0, 1)); a bin keeps its smallest value, so that a bin filled in an
   early round is final. After T rounds, round T + j throws all shingles into bin j, so every bin fills. Two sets agree in a bin
   with a probability near their Jaccard similarity, with bounds like those of independent bins.
2. Documents with equal sets form one class; further steps see one representative of each.
3. Bands of ``ROWS`` bins give bucket keys. Buckets with the same members are looked at once; large ones
   are dealt to chunks of about ``CHUNK`` representatives, each to one.
4. In a chunk, a spanning forest of the best-agreeing pairs is proposed. Large buckets are dealt twice at once; those that are not yet
   one component are dealt anew, and forests of pairs between components proposed, as long as that links anything (``ROUNDS`` deals at
   most). Pairs that agree in fewer bins than a pair
   above the threshold ever would (5 standard deviations) are left out. Proposed pairs are confirmed on the
   full sets of their texts.
5. Connected components of the confirmed links are found by alternating stars. Then all pairs that share a
   bucket, agree enough and still lie in different components are confirmed too: no link between
   components is lost when a proposed pair fails. A bucket's rows are then in parts by component, and only parts that hold
   different components meet, so a bucket of one large component and a few others is not compared with itself. These pairs can be very many in a group of copies near the
   threshold, so they are never rows: a first pass names the representatives of each cell that have such a pair, a
   second one gets their texts and confirms the pairs inside the cell, each pair in the first bucket that it shares.

Chance of missing a pair at the threshold (0.75) in all bands: (1 - 0.75 ** 5) ** 40, about 2e-5; a lost
pair matters only if no other path links the two.

Defined results: null or empty texts and those of white space have 0 shingles and are linked with nothing; a text of
fewer than five words has one shingle, its whole sequence. Rows that share an id count as one document in the
graph, though each row keeps its own n_shingles. A null id is linked with nothing, has a null component and is kept.
An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, buffer_of, in_tasks, materialise, mix64, text_slices

WIDTH = 5
BANDS, ROWS = 40, 5
T = BANDS * ROWS
PERCENT = 75
CHUNK = 512
ROUNDS = 4                 # times that large buckets are dealt to chunks (two at least), until nothing is linked any more
# Of T bins, a pair at the threshold agrees in 150 on average; 5 standard deviations (6.1) below that.
LEAST_AGREEING = int(T * PERCENT / 100 - 5 * (T * PERCENT / 100 * (1 - PERCENT / 100)) ** 0.5)
# Rows for a task: representatives in cells, pairs to confirm, edges of a graph, classes with their sketches, band keys.
CELL_ROWS, PAIR_ROWS, EDGE_ROWS, CLASS_ROWS, KEY_ROWS = 4096, 2000, 100_000, 20_000, 500_000
_U = np.uint64


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, words with A-Z in lower case."""
    words = Words(raw, offsets, lower=True)
    h, sets = words.hash, []
    windows = max(len(h) - width + 1, 0)
    with np.errstate(over="ignore"):
        rolled = np.zeros(windows, _U)
        for k in range(width if windows else 0):
            rolled = mix64(rolled * _U(0x9E3779B97F4A7C15) + h[k:k + windows])
        for first, n in zip(words.first.tolist(), words.count.tolist(), strict=True):
            if n >= width:
                sets.append(np.unique(rolled[first:first + n - width + 1]))
            elif n:
                short = _U(n)
                for x in h[first:first + n]:
                    short = mix64(short * _U(0xD1342543DE82EF95) + x)
                sets.append(np.array([short], _U))
            else:
                sets.append(np.zeros(0, _U))
    return sets


def sketch(sets: list[np.ndarray], t: int = T) -> np.ndarray:
    """t values per set (sets are not empty): equal values mean the same shingle in the same round and bin."""
    n = len(sets)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    bins = np.full(n * t, full, _U)
    element = np.concatenate(sets) if n else np.zeros(0, _U)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    for i in range(2 * t):
        if not len(element):
            break
        with np.errstate(over="ignore"):
            x = mix64(element + _U(i + 1) * _U(0x9E3779B97F4A7C15))
        value = (_U(i) << _U(40)) | (x >> _U(24))
        if i < t:
            place = owner * t + ((x & _U(0xFFFFFF)).astype(np.int64) * t >> 24)
        else:
            place = owner * t + (i - t)
        np.minimum.at(bins, place, value)
        if i < 8 or i % 8 == 0:         # sets with all bins filled are done
            open_sets = (bins.reshape(n, t) == full).any(1)
            left = open_sets[owner]
            element, owner = element[left], owner[left]
    return bins.reshape(n, t)


def band_keys(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, t = values.shape
    parts = values.reshape(n, t // rows, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mix64(np.arange(t // rows, dtype=_U) + _U(77)), (n, t // rows)).copy()
        for k in range(rows):
            key = mix64(key * _U(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            sets = shingle_sets(*buffer_of(part.column("text")))
            filled = [i for i, s in enumerate(sets) if len(s)]
            values = sketch([sets[i] for i in filled])
            with np.errstate(over="ignore"):
                short = (mix64(values) >> _U(56)).astype(np.uint8)
            bands = band_keys(values)
            key, keys, sketches = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            for row, i in enumerate(filled):
                key[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                keys[i], sketches[i] = bands[row], short[row].tobytes()
            passed = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in passed], pa.array([len(s) for s in sets], pa.int64()), pa.array(key, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], [*passed, "n", "key", "bands", "sketch"])


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (shingles), key (digest of the set; null for the empty one), bands, sketch."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_signatures, "doc_id long, n long, key binary, bands array<long>, sketch binary")


# ------------------------------------------------------------------ candidates


def _agreeing(all_sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (all_sketches == one).sum(1)


def _forest(ids: np.ndarray, sketches: np.ndarray, side: np.ndarray | None, least: int) -> list[tuple[int, int]]:
    """Pairs of a maximum spanning forest by agreeing bins (Prim's algorithm); ``side``: only pairs of different sides."""
    m, pairs = len(ids), []
    outside = np.ones(m, bool)
    best, link = np.full(m, -1), np.zeros(m, np.int64)
    for _ in range(m):
        rest = np.flatnonzero(outside)
        k = rest[np.argmax(best[rest])]
        if best[k] >= least:
            pairs.append((int(ids[link[k]]), int(ids[k])))
        else:
            best[:] = -1            # a new tree begins
        outside[k] = False
        rest = np.flatnonzero(outside if side is None else outside & (side != side[k]))
        if len(rest):
            agreeing = _agreeing(sketches[rest], sketches[k])
            better = agreeing > best[rest]
            best[rest[better]], link[rest[better]] = agreeing[better], k
    return pairs


def _crossing(rows: dict[str, np.ndarray], k: int, bucket: int, mixed: bool, least: int) -> np.ndarray:
    """Rows after row k of a cell that are in another component, agree with it in enough bins, and share no earlier bucket."""
    rest = np.arange(k + 1, len(rows["rep"]))
    rest = rest[rows["component"][rest] != rows["component"][k]]
    if mixed:
        rest = rest[rows["part"][rest] != rows["part"][k]]
    if not len(rest):
        return rest
    rest = rest[_agreeing(rows["sketch"][rest], rows["sketch"][k]) >= least]
    own = rows["open"][k]
    shared = (rows["open"][rest] == own) & (own != 0)
    return rest[own[np.argmax(shared, axis=1)] == bucket]


def _columns(batch: pa.RecordBatch, s: int, e: int) -> dict[str, np.ndarray]:
    """A cell's rows as arrays."""
    rows = batch.slice(s, e - s)
    out = {c: rows.column(c).to_numpy() for c in ("rep", "part", "component")}
    out["sketch"] = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(e - s, -1)
    out["open"] = rows.column("open").flatten().to_numpy().reshape(e - s, -1)
    return out


def _by_cell(batches: Iterator[pa.RecordBatch], handle) -> Iterator[pa.RecordBatch]:
    """Calls ``handle(batch, start, end, bucket, mixed)`` for each cell of rows sorted by (bucket, cell); yields the batches
    that it returns. A cell can go on in the next batch."""
    held: list[pa.RecordBatch] = []

    def cells(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        bucket, cell = rows.column("bucket").to_numpy(), rows.column("cell").to_numpy()
        mixed = rows.column("mixed").to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero((np.diff(bucket) != 0) | (np.diff(cell) != 0)) + 1, [len(cell)]])
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if e - s > 1:
                out = handle(rows, s, e, int(bucket[s]), bool(mixed[s]))
                if out is not None:
                    yield out

    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, cell = batch.column("bucket").to_numpy(), batch.column("cell").to_numpy()
        last = np.flatnonzero((bucket != bucket[-1]) | (cell != cell[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if held and (held[-1].column("bucket")[-1].as_py() != int(bucket[0]) or held[-1].column("cell")[-1].as_py() != int(cell[0])):
            yield from cells(held)
            held = []
        if cut:
            yield from cells([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield from cells(held)


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """Rows by cell, each cell in one task; ``n``: about how many rows."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return in_tasks(rows.repartition(tasks, "bucket", "cell"), n, CELL_ROWS).sortWithinPartitions("bucket", "cell", "rep")


def chunks(members: DataFrame, chunk: int) -> DataFrame:
    """Rows with bucket, n, rep and seed, each in one chunk (cell) of its bucket, dealt by a hash of rep and seed."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / chunk)).cast("int")
    return (members.withColumn("cell", F.pmod(F.xxhash64("rep", "seed"), parts).cast("long"))
                   .withColumn("mixed", F.lit(False)).drop("n", "seed"))


def cells(members: DataFrame, chunk: int | None = None) -> DataFrame:
    """Rows with bucket, rep and component, in every cell (pair of parts of the bucket) where they can meet another component.

    A component of more than ``chunk`` rows has parts of its own, which meet no part of the same component; the rows of the other
    components share parts, by component. So a bucket that is one component but for a few rows makes about as many
    rows as it has, and a part is copied only to parts with which it has pairs to look at."""
    chunk = chunk or CHUNK
    sizes = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("m")).withColumn("big", F.col("m") > chunk)
    owner = F.when(F.col("big"), F.col("component"))          # null: a shared part
    parts = (sizes.groupBy("bucket", owner.alias("owner")).agg(F.sum("m").alias("m"))
             .withColumn("n_parts", F.ceil(F.col("m") / chunk).cast("int")))
    listed = (parts.select("bucket", "owner", "n_parts", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("part"))
              .groupBy("bucket").agg(F.collect_list(F.struct("owner", "part", F.xxhash64("owner", "part").alias("key"))).alias("others")))
    shared = parts.where("owner IS NULL").select("bucket", F.col("n_parts").alias("n_shared"))
    of = sizes.join(shared, "bucket", "left").withColumn("n_own", F.ceil(F.col("m") / chunk).cast("int")).drop("m")
    rows = members.join(of, ["bucket", "component"]).join(listed, "bucket")
    number = F.when(F.col("big"), F.pmod(F.xxhash64("rep", F.lit(7)), F.col("n_own"))).otherwise(F.pmod(F.xxhash64("component", F.lit(11)), F.col("n_shared")))
    rows = rows.withColumn("part", F.xxhash64(owner, number.cast("int")))
    meets = F.filter("others", lambda o: o["owner"].isNull() | ~F.col("big") | (o["owner"] != F.col("component")))
    rows = rows.withColumn("other", F.explode(F.transform(meets, lambda o: o["key"])))
    return (rows.withColumn("cell", F.xxhash64(F.least("part", "other"), F.greatest("part", "other")))
                .withColumn("mixed", F.col("part") != F.col("other"))
                .drop("n", "big", "n_own", "n_shared", "others", "other"))


def propose(members: DataFrame, least: int = LEAST_AGREEING, chunk: int | None = None) -> DataFrame:
    """Distinct pairs (a < b) of the spanning forests of the buckets' chunks, from rows (bucket, n, rep, seed, component, sketch):
    pairs of different components only (null: none yet, a row by itself). ``members`` comes from a stored table: its rows are counted."""
    n = members.count()

    def forest(rows: pa.RecordBatch, s: int, e: int, bucket: int, mixed: bool) -> pa.RecordBatch | None:
        part = rows.slice(s, e - s)
        sketches = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(e - s, -1)
        known = part.column("component")
        pairs = _forest(part.column("rep").to_numpy(), sketches, None if known.null_count else known.to_numpy(), least)
        a = np.array(pairs, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(a.min(1)), pa.array(a.max(1))], ["a", "b"]) if len(a) else None

    pairs = _dealt(chunks(members, chunk or CHUNK), n).mapInArrow(lambda batches: _by_cell(batches, forest), "a long, b long")
    return in_tasks(pairs.distinct(), n, EDGE_ROWS)


def crossing_links(members: DataFrame, texts: DataFrame, least: int = LEAST_AGREEING, chunk: int | None = None) -> DataFrame:
    """Links (a, b) between components, from rows (bucket, n, rep, component, sketch, open): ``open`` has the keys of the
    representative's buckets by band, 0 for those that need no look. ``members`` is a stored table: it is read twice."""
    def named(rows: pa.RecordBatch, s: int, e: int, bucket: int, mixed: bool) -> pa.RecordBatch | None:
        cell, wanted = _columns(rows, s, e), np.zeros(e - s, bool)
        for k in range(e - s - 1):
            near = _crossing(cell, k, bucket, mixed, least)
            if len(near):
                wanted[k] = True
                wanted[near] = True
        return rows.slice(s, e - s).filter(pa.array(wanted)) if wanted.any() else None

    def linked(rows: pa.RecordBatch, s: int, e: int, bucket: int, mixed: bool) -> pa.RecordBatch | None:
        cell = _columns(rows, s, e)
        sets = [t for part in text_slices(rows.slice(s, e - s).select(["text"])) for t in shingle_sets(*buffer_of(part.column("text")))]
        links, component = [], cell["component"].copy()
        cell["component"] = component       # follows the links found here
        for k in range(e - s - 1):
            for j in _crossing(cell, k, bucket, mixed, least).tolist():
                if component[j] != component[k]:        # not yet joined by a link of this cell
                    common = len(np.intersect1d(sets[k], sets[j], assume_unique=True))
                    if common and 100 * common >= PERCENT * (len(sets[k]) + len(sets[j]) - common):
                        links.append(sorted((int(cell["rep"][k]), int(cell["rep"][j]))))
                        component[component == component[j]] = component[k]
        a = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"]) if len(a) else None

    columns = ["bucket", "cell", "mixed", "part", "rep", "component", "sketch", "open"]
    # Cells are found on the ids alone; sketches join the rows once their number is known.
    placed = materialise(cells(members.drop("sketch", "open"), chunk), "cells")
    rows = placed.join(members.select("bucket", "rep", "sketch", "open"), ["bucket", "rep"]).select(*columns)
    n = placed.count()
    found = materialise(_dealt(rows, n).mapInArrow(lambda batches: _by_cell(batches, named), rows.schema), "crossing")
    n = found.count()
    return in_tasks(_dealt(found.join(texts, "rep").select(*columns, "text"), n).mapInArrow(
        lambda batches: _by_cell(batches, linked), "a long, b long").distinct(), n, EDGE_ROWS)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text_b", 1_000_000):
            known: dict[tuple[str, int], int] = {}
            texts: list[str] = []

            def number(text: str) -> int:
                if text not in known:
                    known[text] = len(texts)
                    texts.append(text)
                return known[text]

            pairs = [(number(a or ""), number(b or "")) for a, b in zip(part.column("text_a").to_pylist(), part.column("text_b").to_pylist(), strict=True)]
            sets = shingle_sets(*buffer_of(pa.array(texts, pa.large_string())))
            linked = []
            for i, j in pairs:
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                linked.append(bool(common) and 100 * common >= PERCENT * (len(sets[i]) + len(sets[j]) - common))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, linked) for pairs of ids, on the full sets of their texts (rep, text). ``pairs`` is a stored table."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return in_tasks(both, pairs.count(), PAIR_ROWS).mapInArrow(_confirm, "a long, b long, linked boolean")


# ------------------------------------------------------------------ components


def _stars(edges: DataFrame, n: int) -> bool:
    """Whether each node of ``edges`` (u > v) is the v of some or the u of one: stars round the smallest node of each component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    ends = in_tasks(ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count(F.lit(1)).alias("n")), n, EDGE_ROWS)
    return ends.agg(F.max((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("ups") < F.col("n"))))).first()[0] is not True


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of links (a, b), a stored table: the smallest node that can be reached. Alternating stars: each
    round joins every node's larger neighbours, then its smaller ones, to its smallest neighbour, until only stars are left."""
    n = links.count()
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        edges = materialise(in_tasks(edges, n, EDGE_ROWS), "edges")
        if _stars(edges, n):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = in_tasks(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), n, EDGE_ROWS)
        large = in_tasks(both.join(least, "u"), n, EDGE_ROWS).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(in_tasks(large, n, EDGE_ROWS), "edges")
        least = in_tasks(large.groupBy("u").agg(F.min("v").alias("m")), n, EDGE_ROWS)
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = in_tasks(small, n, EDGE_ROWS).where("u <> v").distinct()


# ------------------------------------------------------------------ the operator


def _labels(classes: DataFrame, texts_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of the classes (rep, bands, sketch) that are linked with others; ``texts_of`` gives the rows (rep, text) of the
    classes of a table (rep)."""
    n = classes.count()
    rows = classes.select(F.explode("bands").alias("bucket"), "rep")
    full = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("first"), F.bit_xor(F.xxhash64("rep")).alias("x")).where("n > 1")
    full = in_tasks(full, n * BANDS, KEY_ROWS)
    buckets = in_tasks(full.groupBy("n", "first", "x").agg(F.min("bucket").alias("bucket")).select("bucket", "n"), n * BANDS, KEY_ROWS)
    # A representative's buckets stay with it, as a list of one for each band at most: joins are of one row per representative,
    # which then goes out to its buckets.
    members = in_tasks(rows.join(buckets, "bucket").select("bucket", "n", "rep"), n * BANDS, KEY_ROWS)
    members = members.groupBy("rep").agg(F.collect_list(F.struct("bucket", "n")).alias("held"))
    sketches = materialise(in_tasks(classes.join(members, "rep").select("rep", "sketch", "bands", "held"), n, CLASS_ROWS), "sketches")
    m = sketches.agg(F.sum(F.size("held"))).first()[0] or 0
    texts = materialise(in_tasks(texts_of(sketches.select("rep")), n, CLASS_ROWS), "texts")

    def proposed(reps: DataFrame, seeds: list[int]) -> DataFrame:
        """The links among the pairs that the forests propose, from a stored table (rep, component, sketch, held). Small buckets
        are dealt by the first seed only."""
        deals = F.flatten(F.transform("held", lambda b: F.transform(
            F.filter(F.array(*map(F.lit, seeds)), lambda s: (s == seeds[0]) | (b["n"] > CHUNK)),
            lambda s: F.struct(b["bucket"].alias("bucket"), b["n"].alias("n"), s.alias("seed")))))
        rows = reps.select("rep", "component", "sketch", F.explode(deals).alias("deal")).select(
            "deal.bucket", "deal.n", "rep", "deal.seed", "component", "sketch")
        return materialise(confirm(materialise(propose(rows), "pairs"), texts).where("linked").select("a", "b"), "links")

    def by_rep(rows: DataFrame, n: int) -> DataFrame:
        """(rep, component, sketch, bands, held) of rows (bucket, n, rep, component)."""
        own = rows.groupBy("rep").agg(F.first("component").alias("component"), F.collect_list(F.struct("bucket", "n")).alias("held"))
        return in_tasks(sketches.drop("held").join(in_tasks(own, n, CLASS_ROWS), "rep"), n, CLASS_ROWS)

    # A large bucket is dealt twice at first: what a chunk of one deal does not link, one of the other may.
    links = proposed(sketches.withColumn("component", F.lit(None).cast("long")), [0, 1])
    for seed in range(2, max(ROUNDS, 2) + 1):
        labels = components(links)
        now = in_tasks(sketches.select("rep", "held").join(labels, F.col("rep") == F.col("node"), "left"), n, CLASS_ROWS).select(
            "rep", F.coalesce("component", "rep").alias("component"), F.explode("held").alias("in")).select("in.bucket", "in.n", "rep", "component")
        sizes = now.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("m"))
        unsettled = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("bucket")
        now = materialise(in_tasks(now.join(unsettled, "bucket"), m, KEY_ROWS), "unsettled")
        # Chunks of large buckets are dealt anew: what one round linked inside chunks, the next links across them.
        large = now.where(F.col("n") > CHUNK)
        left = 0 if seed >= ROUNDS else large.count()
        if not left:
            break
        more = proposed(materialise(by_rep(large, left), "proposing"), [seed])
        if more.isEmpty():
            break
        links = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)
    own = F.transform("held", lambda b: b["bucket"])
    open_keys = F.transform("bands", lambda k: F.when(F.array_contains("own", k), k).otherwise(0)).alias("open")
    rows = by_rep(now, now.count()).withColumn("own", own).select("rep", "component", "sketch", open_keys, F.explode("held").alias("in"))
    rows = materialise(rows.select("in.bucket", "in.n", "rep", "component", "sketch", "open"), "open")
    more = materialise(crossing_links(rows, texts), "links")
    if not more.isEmpty():
        labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    found = materialise(signatures(docs, id_col, text_col), "signatures")
    classes = found.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = materialise(in_tasks(classes, found.count(), CLASS_ROWS), "classes")
    labels = _labels(classes, lambda reps: docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")).join(reps, "rep"))

    out = found.select("doc_id", "n", "key").join(classes.select("key", "rep"), "key", "left")
    out = out.join(labels, out["rep"] == labels["node"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op10_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, all columns, without the near-duplicates of an earlier one: of each group one row stays, with the smallest id
    (no id is the largest). A row counts by its id and text, so one id can have several texts. Of rows with the same id and
    text one stays, also where both are null or the text has no shingles."""
    row_id, row_hash = docs["doc_id"].cast("long"), F.xxhash64(docs["text"], docs["text"].isNull())
    found = docs.select(row_id.alias("doc_id"), row_hash.alias("hash"), docs["text"])
    found = materialise(found.mapInArrow(_signatures, "doc_id long, hash long, n long, key binary, bands array<long>, sketch binary"), "signatures")
    # Numbers are given once and stored; a class has the text of its first row.
    classes = found.where("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "hash")).alias("first"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = materialise(in_tasks(classes, found.count(), CLASS_ROWS).withColumn("rep", F.monotonically_increasing_id()), "classes")

    def texts_of(reps: DataFrame) -> DataFrame:
        wanted = classes.join(reps, "rep").select("rep", F.col("first.doc_id").alias("of_id"), F.col("first.hash").alias("of_hash"))
        rows = docs.select(row_id.alias("row_id"), row_hash.alias("row_hash"), docs["text"])
        rows = rows.join(wanted, F.col("row_id").eqNullSafe(F.col("of_id")) & (F.col("row_hash") == F.col("of_hash")))
        return rows.groupBy("rep").agg(F.first("text").alias("text"))       # repeated rows

    labels = _labels(classes, texts_of)
    rows = found.groupBy("doc_id", "hash", "key").agg(F.count(F.lit(1)).alias("times"))
    joined = rows.where("key IS NOT NULL").join(classes.select("key", "rep"), "key")
    joined = joined.join(labels, joined["rep"] == labels["node"], "left").withColumn("group", F.coalesce("component", "rep"))
    first = joined.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "hash", "times")).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("kept_id"), F.col("first.hash").alias("kept_hash"), F.col("first.times").alias("kept_times"))
    kept = materialise(kept.union(rows.where("key IS NULL").select("doc_id", "hash", "times")), "kept")

    def rows_of(some: DataFrame) -> DataFrame:
        return docs.join(some, row_id.eqNullSafe(some["kept_id"]) & (row_hash == some["kept_hash"]), "left_semi")

    once, repeated = rows_of(kept.where("kept_times = 1")), rows_of(kept.where("kept_times > 1"))
    # Of repeated rows with different other columns, always the same one.
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
    return once.union(repeated.groupBy(row_id.alias("kept_id"), row_hash.alias("kept_hash")).agg(one).select("row.*"))
