"""Substring deduplication by prefix-partitioned suffix trees over words.

A window is ``WINDOW`` consecutive words; the suffix that starts with it belongs to the tree. Suffixes are dealt to trees by
prefixes of variable length: a suffix's prefix ends with the least (by hash) run of ``GRAM`` words that its window holds, and that run is
the name of the tree. So the prefix has between GRAM and WINDOW words, equal windows have equal prefixes and meet in one tree, and
suffixes of neighbouring words mostly share a tree: they are shipped as one fragment of text instead of one copy of the text each.

1. One map hashes the words of whole texts, cuts each into fragments and stores blocks of documents, bucketed, with the
   names of the trees of their fragments.
2. Documents with equal words form a class: all but those with the smallest id are repeated as a whole and need no tree.
3. The blocks' distinct tree names meet (once per block): a tree whose suffixes lie in one document only holds no repeat.
4. Fragments of the other trees are shipped and grouped by name. A task sorts the suffixes of a group by doubling ranks, takes the common
   prefix lengths of neighbours from the ranks, and reads the tree's internal nodes of depth WINDOW or more off them: a run of neighbours
   with that much in common. The smallest id below such a node is the repeat's first holder.
5. A name with over ``GROUP`` fragments does not fit a task: there the prefix is lengthened to the whole window, whose subtree is a
   single node; Spark finds its smallest id by a grouped minimum, first within blocks.
6. The windows found go back to their blocks; neighbouring windows join to maximal repeats.

Words are compared by 64-bit hashes.

Defined results: a word is removed when a window that covers it also starts in a document with a smaller id. Rows that share an id do not
remove each other's words; a null id is neither smaller nor larger than another, so such rows keep all words and remove none. Null, empty
and short texts have no windows. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, buffer_of, materialise, mix64, scratch_dir, text_slices
from .pretokens import pack, unpack

WINDOW = 50
GRAM = 16
GROUP = 2048                   # fragments of one tree in a task
AT_ONCE = 16_384               # fragments whose suffixes are sorted together (whole groups)
BLOCK_BYTES = 8_000_000
_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ fragments


def _joined(h: np.ndarray, shift: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(h[:len(h) - shift] * _MULT + h[shift:]) if len(h) > shift else np.zeros(0, _U)


def run_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words, from the hashes of runs of half the size (overlapping where it is no power of two)."""
    size = 1
    while size * 2 <= length:
        h, size = _joined(h, size), size * 2
    return _joined(h, length - size) if size < length else h


def least_places(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest (first of equal) of ``values[i : i + span]``, for each i."""
    place, size = np.arange(len(values)), 1

    def step(place: np.ndarray, by: int) -> np.ndarray:
        left, right = place[:len(place) - by], place[by:]
        return np.where(values[right] < values[left], right, left)

    while size * 2 <= span:
        place, size = step(place, size), size * 2
    return step(place, span - size) if size < span else place


def fragments(words: Words, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of texts: name of the tree, row, first word (within the row) and number of windows."""
    none = np.zeros(0, np.int64)
    if len(words.hash) < window:
        return none.astype(_U), none, none, none
    names = run_hashes(words.hash, gram)
    with np.errstate(over="ignore"):
        least = least_places(mix64(names + _U(5)), window - gram + 1)
    start = np.arange(len(words.hash) - window + 1)
    row = words.doc[start]
    inside = start + window <= (words.first + words.count)[row]
    start, least, row = start[inside], least[inside], row[inside]
    if not len(start):
        return none.astype(_U), none, none, none
    cut = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (row[1:] != row[:-1])))
    return names[least[cut]], row[cut], start[cut] - words.first[row[cut]], np.diff(np.append(cut, len(start)))


_DIGESTS = pa.list_(pa.struct([("digest", pa.binary()), ("least", pa.int64()), ("most", pa.int64()), ("members", pa.binary())]))


def _digest_keys(digests: list[bytes | None], ids: list[int | None]) -> list[dict]:
    at = np.array([i for i, d in enumerate(digests) if d is not None and ids[i] is not None], np.int64)
    names, entry = np.unique(np.array([digests[i] for i in at], "S16"), return_inverse=True)
    found = packed_keys([entry], at, np.zeros_like(at), np.array([ids[i] for i in at], np.int64))
    digest = [digests[np.frombuffer(m, "<i8")[0]] for m in found["members"]]
    return [dict(digest=d, least=a, most=b, members=m) for d, a, b, m in zip(digest, found["least"].tolist(), found["most"].tolist(), found["members"], strict=True)]


def make_blocks(docs: DataFrame, window: int, gram: int, block_bytes: int) -> DataFrame:
    """The stored table of blocks: ids, texts, digests of the word sequences (null: no window), and the fragments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size, ids, texts, digests, found = 0, 0, [], [], [], []

        def block() -> pa.RecordBatch:
            name, row, first, n = (np.concatenate(x) for x in zip(*found, strict=True))
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())),
                "texts": pa.array([texts], pa.list_(pa.string())), "digests": pa.array([_digest_keys(digests, ids)], _DIGESTS),
                "names": [name.tobytes()], "rows": [pack(row)], "firsts": [pack(first)], "counts": [pack(n)]})

        for batch in batches:
            for part in text_slices(batch):
                words = Words(*buffer_of(part.column("text")))
                name, row, first, n = fragments(words, window, gram)
                found.append((name, row + len(ids), first, n))
                digests += [hashlib.blake2b(words.hash[a:a + k].tobytes(), digest_size=16).digest() if k >= window else None
                            for a, k in zip(words.first.tolist(), words.count.tolist(), strict=True)]
                ids += part.column("doc_id").to_pylist()
                texts += part.column("text").to_pylist()
                size += part.column("text").nbytes
                if size >= block_bytes:
                    yield block()
                    made, size, ids, texts, digests, found = made + 1, 0, [], [], [], []
        if ids:
            yield block()

    rows = docs.mapInArrow(run, "block long, ids array<long>, texts array<string>, digests array<struct<digest:binary,least:bigint,most:bigint,members:binary>>, names binary, rows binary, "
                                "firsts binary, counts binary")
    spark = docs.sparkSession
    name = f"quantleaf_suffixes_{uuid.uuid4().hex}"
    (rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").format("parquet")
         .option("compression", "zstd").option("path", scratch_dir(spark, "suffixes")).saveAsTable(name))
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")     # the catalog entry only: the files at the given path stay
    return blocks


# ------------------------------------------------------------------ first holders of equal keys


def packed_keys(keys: list[np.ndarray], row: np.ndarray, first: np.ndarray, doc: np.ndarray) -> dict:
    """Distinct keys (rows of ``keys``) with their least and greatest doc and their members (row, first, doc) as bytes."""
    order = np.lexsort((*reversed(keys),))
    new = np.append(True, np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0))[:len(order)]
    at = np.flatnonzero(new)
    members = np.stack([row, first, doc], 1).astype("<i8")[order]
    bounds = [*at.tolist(), len(order)]
    return {"keys": [k[order][at] for k in keys], "members": [members[s:e].tobytes() for s, e in zip(bounds, bounds[1:], strict=False)],
            "least": np.minimum.reduceat(members[:, 2], at) if len(at) else np.zeros(0, np.int64),
            "most": np.maximum.reduceat(members[:, 2], at) if len(at) else np.zeros(0, np.int64)}


def later_members(held: list[dict] | None) -> np.ndarray:
    """row, first, 1, source of the members whose doc is larger than the key's ``source``."""
    found = [np.zeros((0, 4), np.int64)]
    for h in held or []:
        m = np.frombuffer(h["members"], "<i8").reshape(-1, 3)
        m = m[m[:, 2] > h["source"]]
        found.append(np.stack([m[:, 0], m[:, 1], np.ones(len(m), np.int64), np.full(len(m), h["source"])], 1))
    return np.concatenate(found)


def first_holders(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """block, ``name``: the members of keys (block, keys, least, most, members) that also has a document with a smaller id, the ``source``.

    A key comes once or a few times per block with its members packed, so few rows meet, however often it occurs."""
    held = rows.withColumn("source", F.min("least").over(Window.partitionBy(*keys))).where("source < most")
    return held.groupBy("block").agg(F.collect_list(F.struct("source", "members")).alias(name))


def whole_copies(blocks: DataFrame) -> DataFrame:
    """block, copies: the rows whose words are those of a document with a smaller id."""
    rows = blocks.select("block", F.explode("digests").alias("d")).select("block", "d.*")
    return materialise(first_holders(rows, ["digest"], "copies"), "suffix-copies")


# ------------------------------------------------------------------ trees


def _own_fragments(row: dict) -> tuple[np.ndarray, ...]:
    """The block's fragments that need a tree: those of rows that have an id and are no copies."""
    name = np.frombuffer(row["names"].as_py(), _U)
    at, first, n = (unpack(row[c].as_py()).astype(np.int64) for c in ("rows", "firsts", "counts"))
    ids = row["ids"].values
    out = ids.is_null().to_numpy(zero_copy_only=False).copy()
    out[later_members(row["copies"].as_py())[:, 0]] = True
    keep = ~out[at] if len(at) else np.zeros(0, bool)
    return name[keep], at[keep], first[keep], n[keep], ids.fill_null(0).to_numpy()


def tree_names(blocks: DataFrame, copies: DataFrame, group: int) -> DataFrame:
    """block, trees: the names in it whose suffixes lie in two documents or more, and whether a name has over ``group`` fragments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                name, at, _, _, ids = _own_fragments(row)
                distinct, entry, times = np.unique(name, return_inverse=True, return_counts=True)
                least, most = np.full(len(distinct), np.iinfo(np.int64).max), np.full(len(distinct), np.iinfo(np.int64).min)
                np.minimum.at(least, entry, ids[at])
                np.maximum.at(most, entry, ids[at])
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array(np.full(len(distinct), row["block"].as_py()), pa.int64()), "name": pa.array(distinct.view(np.int64)),
                    "least": pa.array(least), "most": pa.array(most), "n": pa.array(times.astype(np.int64))})

    entries = (blocks.select("block", "ids", "names", "rows", "firsts", "counts").join(copies, "block", "left")
                     .mapInArrow(run, "block long, name long, least long, most long, n long"))
    w = Window.partitionBy("name")
    shared = entries.select("block", "name", F.min("least").over(w).alias("least"), F.max("most").over(w).alias("most"),
                            (F.sum("n").over(w) > group).alias("large")).where("least < most")
    return shared.groupBy("block").agg(F.collect_list(F.struct("name", "large")).alias("trees"))


def shipped(blocks: DataFrame, copies: DataFrame, trees: DataFrame, window: int, gram: int) -> DataFrame:
    """Fragments of shared trees (block, name, row, first, doc, text) and, for large trees, their distinct windows
    (block, key_1, key_2, least, most, members)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                name, at, first, n, ids = _own_fragments(row)
                tree = row["trees"].values
                names = tree.field("name").to_numpy().view(_U)
                order = np.argsort(names)
                large = tree.field("large").to_numpy(zero_copy_only=False)[order]
                names = names[order]
                place = np.minimum(np.searchsorted(names, name), len(names) - 1)
                keep = names[place] == name
                large, name, at, first, n = large[place][keep], name[keep], at[keep], first[keep], n[keep]
                block, texts = row["block"].as_py(), row["texts"].values
                used = np.unique(at)
                rows = pa.RecordBatch.from_arrays([pa.array(used), texts.take(pa.array(used))], ["row", "text"])
                for part in text_slices(rows):
                    raw, offsets = buffer_of(part.column("text"))
                    words = Words(raw, offsets)
                    here = part.column("row").to_numpy()
                    mine = (at >= here[0]) & (at <= here[-1])
                    a, f, k, big, g = at[mine], first[mine], n[mine], large[mine], name[mine]
                    begin = words.first[np.searchsorted(here, a)] + f
                    data = raw.tobytes()
                    cold = ~big
                    text = [data[s:e] for s, e in zip(words.start[begin[cold]].tolist(), words.end[begin[cold] + k[cold] + window - 2].tolist(), strict=True)]
                    yield _filled({"block": np.full(len(text), block), "name": g[cold].view(np.int64), "row": a[cold], "first": f[cold],
                                   "doc": ids[a[cold]], "text": pa.array(text, pa.binary()).cast(pa.string())})
                    if big.any():
                        one, two = run_hashes(words.hash, window), run_hashes(words.hash ^ _MULT, window)
                        k, a, f, begin = k[big], a[big], f[big], begin[big]
                        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                        spot, owner = np.repeat(begin, k) + step, np.repeat(a, k)
                        found = packed_keys([one[spot].view(np.int64), two[spot].view(np.int64)], owner, np.repeat(f, k) + step, ids[owner])
                        yield _filled({"block": np.full(len(found["least"]), block), "key_1": found["keys"][0], "key_2": found["keys"][1],
                                       **{c: found[c] for c in ("least", "most", "members")}})

    rows = (blocks.select("block", "ids", "texts", "names", "rows", "firsts", "counts").join(trees, "block").join(copies, "block", "left")
                  .mapInArrow(run, ", ".join(f"{c} {t}" for c, (t, _) in _SHIPPED.items())))
    return materialise(rows, "suffix-fragments")


_SHIPPED = {"block": ("long", pa.int64()), "name": ("long", pa.int64()), "row": ("int", pa.int32()), "first": ("int", pa.int32()),
            "doc": ("long", pa.int64()), "text": ("string", pa.string()), "key_1": ("long", pa.int64()), "key_2": ("long", pa.int64()),
            "least": ("long", pa.int64()), "most": ("long", pa.int64()), "members": ("binary", pa.binary())}


def _filled(given: dict) -> pa.RecordBatch:
    """A batch of ``_SHIPPED`` columns, null where not given."""
    n = len(given["block"])
    return pa.RecordBatch.from_pydict({c: pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, (_, t) in _SHIPPED.items()})


def deep_nodes(words: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` in their tree, and for each in this order the number of the topmost node of depth ``depth`` or
    more above it (a leaf's own where there is none). Each suffix has at least ``depth`` words; ``words`` are their hashes."""
    ranks, size = [np.unique(words, return_inverse=True)[1]], 1
    while size * 2 <= depth:
        r = ranks[-1]
        after = np.zeros_like(r)
        after[:len(r) - size] = r[size:] + 1
        ranks.append(np.unique(r * (len(r) + 2) + after, return_inverse=True)[1])
        size *= 2
    top = ranks[-1]
    order = np.lexsort((top[starts + depth - size], top[starts]))       # ranks of the first and the last ``size`` words
    here, there = starts[order][:-1], starts[order][1:]
    common = np.zeros(len(here), np.int64)      # of neighbours: read off the ranks, longest runs first
    for r, n in zip(reversed(ranks), [size >> i for i in range(len(ranks))], strict=True):
        a, b = np.minimum(here + common, len(r) - 1), np.minimum(there + common, len(r) - 1)
        common += n * (r[a] == r[b])
    return order, np.cumsum(np.append(True, common < depth)) - 1


def tree_repeats(fragments_: DataFrame, window: int, at_once: int) -> DataFrame:
    """block, row, first, n, source: runs of windows that also start in the document ``source`` with a smaller id."""
    def search(rows: pa.Table) -> pa.RecordBatch:
        words = Words(*buffer_of(rows.column("text").combine_chunks()))
        n = words.count - window + 1
        owner = np.repeat(np.arange(len(n)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        order, node = deep_nodes(words.hash, words.first[owner] + step, window)
        doc = rows.column("doc").to_numpy()[owner]
        least = np.minimum.reduceat(doc[order], np.flatnonzero(np.diff(node, prepend=-1)))
        source = np.empty(len(owner), np.int64)
        source[order] = least[node]
        hit = np.flatnonzero(source < doc)
        new = np.append(True, (np.diff(hit) != 1) | (np.diff(owner[hit]) != 0) | (np.diff(source[hit]) != 0))[:len(hit)]
        at = hit[new]
        length = np.diff(np.append(np.flatnonzero(new), len(hit)))
        return pa.RecordBatch.from_pydict({
            **{c: rows.column(c).combine_chunks().take(pa.array(owner[at])) for c in ("block", "row")},
            "first": pa.array(rows.column("first").to_numpy()[owner[at]] + step[at], pa.int32()), "n": pa.array(length, pa.int32()),
            "source": pa.array(source[at], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:              # rows come in order of the name
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= at_once:
                rows = pa.Table.from_batches(held)
                name = rows.column("name").to_numpy()
                cut = int(np.searchsorted(name, name[-1]))      # the last group may go on
                if cut:
                    yield search(rows.slice(0, cut))
                    held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield search(pa.Table.from_batches(held))

    spark = fragments_.sparkSession
    return (fragments_.where("name IS NOT NULL").select("name", "block", "row", "first", "doc", "text")
                      .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name").sortWithinPartitions("name")
                      .mapInArrow(run, "block long, row int, first int, n int, source long"))


# ------------------------------------------------------------------ results


def find_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP, at_once: int = AT_ONCE,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The stored blocks with what was found in them: ids, texts, copies, hits (row, first, n, source), windows of large trees."""
    blocks = make_blocks(docs, window, gram, block_bytes)
    copies = whole_copies(blocks)
    sent = shipped(blocks, copies, tree_names(blocks, copies, group), window, gram)
    by_block = (tree_repeats(sent, window, at_once).groupBy("block")
                .agg(F.collect_list(F.struct("row", "first", "n", "source")).alias("hits")))
    windows = sent.where("key_1 IS NOT NULL").select("block", "key_1", "key_2", "least", "most", "members")
    return (blocks.select("block", "ids", "texts").join(copies, "block", "left").join(by_block, "block", "left")
                  .join(first_holders(windows, ["key_1", "key_2"], "windows"), "block", "left").drop("block"))


def _hits(row: dict) -> tuple[list, dict[int, int], np.ndarray]:
    copies = {r: source for r, _, _, source in later_members(row["copies"].as_py()).tolist()}
    found = row["hits"].values if row["hits"].is_valid else None
    table = later_members(row["windows"].as_py())
    if found is not None and len(found):
        table = np.concatenate([table, np.stack([found.field(c).to_numpy().astype(np.int64) for c in ("row", "first", "n", "source")], 1)])
    return row["ids"].as_py(), copies, table[np.lexsort((table[:, 1], table[:, 0]))]


def _rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """Maximal repeats: doc_id, first_word, n_words, source. All of a repeat's windows also start in ``source``, the smallest id that has them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                ids, copies, table = _hits(row)
                out = [(ids[at], 0, len(row["texts"].values[at].as_py().encode().split()), source) for at, source in copies.items()]
                at, first, n, source = table.T
                new = np.append(True, (np.diff(at) != 0) | (first[1:] != first[:-1] + n[:-1]) | (np.diff(source) != 0))[:len(at)]
                spot = np.flatnonzero(new)
                length = np.add.reduceat(n, spot) if len(spot) else n
                out += [(ids[a], f, k + window - 1, s) for a, f, k, s in zip(at[spot].tolist(), first[spot].tolist(), length.tolist(),
                                                                           source[spot].tolist(), strict=True)]
                yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "first_word", "n_words", "source"), r, strict=True)) for r in out],
                                                 pa.schema([(c, pa.int64()) for c in ("doc_id", "first_word", "n_words", "source")]))

    return (find_repeats(_rows_of(docs, id_col, text_col), window=window, **sizes)
            .mapInArrow(run, "doc_id long, first_word long, n_words long, source long"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """doc_id, n_words, n_removed and the text of the words that stay, joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                ids, copies, table = _hits(row)
                edges = np.searchsorted(table[:, 0], np.arange(len(ids) + 1))
                texts = row["texts"].values
                n_words, n_removed, kept = [], [], []
                for at in range(len(ids)):
                    words = (texts[at].as_py() or "").encode().split()       # bytes: splits at the white space of ASCII only
                    n_words.append(len(words))
                    if at in copies:
                        words = []
                    elif edges[at] < edges[at + 1]:
                        gone = np.zeros(len(words) + 1, np.int64)
                        first, n = table[edges[at]:edges[at + 1], 1], table[edges[at]:edges[at + 1], 2]
                        np.add.at(gone, first, 1)
                        np.add.at(gone, first + n + window - 1, -1)
                        words = [words[k] for k in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                    if len(ids) == at + 1 or at % 2000 == 1999:
                        a = at + 1 - len(kept)
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids[a:at + 1], pa.int64()), "n_words": pa.array(n_words, pa.int64()),
                                                          "n_removed": pa.array(n_removed, pa.int64()), "text": pa.array(kept, pa.string())})
                        n_words, n_removed, kept = [], [], []

    return (find_repeats(_rows_of(docs, id_col, text_col), window=window, **sizes)
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, text string"))


def op12_query(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT r, doc_id, place, md5(array_to_string(words[place:place + {WINDOW - 1}], ' ')) AS k
  FROM (SELECT *, unnest(range(1, len(words) - {WINDOW - 2})) AS place FROM d)),
first_holder AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k),
covered AS (
  SELECT r, list(DISTINCT place) AS gone
  FROM (SELECT r, unnest(range(place, place + {WINDOW})) AS place FROM windows JOIN first_holder USING (k) WHERE least < doc_id)
  GROUP BY r),
marked AS (
  SELECT d.doc_id, words, list_filter(range(1, len(words) + 1), lambda i: gone IS NULL OR NOT list_contains(gone, i)) AS stay
  FROM d LEFT JOIN covered USING (r))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - len(stay) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_transform(stay, lambda i: words[i]), ' '), '')) AS kept_sha256
FROM marked
"""
