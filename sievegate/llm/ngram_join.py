"""N-gram Jaccard self-join of documents by token-combination prefixes."""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievegate.llm import arrays, repeats
from sievegate.llm.components import roots
from sievegate.llm.shared import drop, stored

SHINGLE_WORDS = 3
#: Two sets link when PARTS * intersection >= LINK * union.
LINK, PARTS = 90, 100
#: Shingles in 2**FREQUENT documents or more are indexed by pairs, rarer ones alone.
FREQUENT = 6
#: Frequent shingles form so many classes, fewer for small sets and more for large ones; a pair lies within one.
CLASSES = 8
#: Bits of a set's parity sketch.
SKETCH = 1024
#: Rounds in which buckets are tested against one member only.
HUB_ROUNDS = 2
#: Members of a bucket that meet in one place at most; larger buckets are cut, and cuts meet in pairs.
TILE_ROWS = 1024
#: Bucket rows that a task takes together, on average.
TASK_ROWS = 20_000
#: Bytes of text in a block; a task holds the sets of one.
BLOCK_BYTES = 4 << 20
#: Bits of the keys by which document frequencies are counted.
KEY_BITS = 44
_ENTRY = (
    "row long, doc_id long, n long, fp_a long, fp_b long, alone boolean, "
    "sigs array<bigint>, sketch binary, hashes binary"
)


class Rule(NamedTuple):
    """Words of a shingle, and when sets link: ``parts`` * intersection >= ``link`` * union."""

    words: int = SHINGLE_WORDS
    link: int = LINK
    parts: int = PARTS


def shingle_sets(block: repeats.Block, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document, A-Z lower-cased.

    A document with fewer words than a shingle has its whole sequence as the only one.
    """
    data = block.data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    codes, bounds, distinct = arrays.words(data, block.offsets)
    hashed = arrays.hash_words(distinct)[codes]
    rolled = arrays.rolling_hashes(hashed, words)
    sets = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= words:
            found = arrays.distinct_of(rolled[lo : hi - words + 1])
        elif hi > lo:
            found = arrays.rolling_hashes(hashed[lo:hi], hi - lo, base=2 * (hi - lo) + 0x9E3779B97F4A7C01)
        else:
            found = np.zeros(0, np.uint64)
        sets.append(found)
    return sets


def fewest_missing(size: int, link: int = LINK, parts: int = PARTS) -> int:
    """Most members of a set of ``size`` that can be missing in a set it links with."""
    return size - (link * size + parts - 1) // parts


def bands_of(size: int, link: int = LINK, parts: int = PARTS) -> range:
    """Size bands (powers of two) that the larger of a set of ``size`` and a set it links with may be in."""
    return range(size.bit_length() - 1, (parts * size // link).bit_length())


def classes_in(band: int) -> int:
    """Classes of frequent members for pairs of sets whose larger one is in the band.

    The smaller one has link / parts * 2**band members at least and shares as large a part of them;
    those must be more than the classes, or each could lie alone in its class. From sets of 128 on
    the classes grow with the band, so that a set has about as many signatures as members at most.
    """
    return max(min(CLASSES, 1 << max(0, band - 1)), 1 << max(0, band - 3))


def signatures(hashes: np.ndarray, levels: np.ndarray, allowed: int, bands: range) -> list[int]:
    """Signatures of one set; two sets that link share at least one.

    There are signatures for every band that the larger set of a pair may be in, since both sets
    must use as many classes; ``bands_of`` tells the bands.

    Members are ordered by level (rare first), then hash. Of a prefix, at most ``allowed`` members
    are missing in a partner. Rare members are signatures themselves. Frequent ones belong to
    classes by their hash, and the pairs within a class are signatures: a class of p members with
    no shared pair has p - 1 missing ones at least. The prefix ends as soon as a partner without a
    shared signature would miss more than ``allowed`` members. Members of level 0 occur once in
    the corpus: they count as missing and need no signature.
    """
    found: set[int] = set()
    order = np.lexsort((hashes, levels))
    for band in bands:
        missing, count = 0, classes_in(band)
        classes: dict[int, list[int]] = {}
        for i in order:
            if missing > allowed:
                break
            value, level = int(hashes[i]), levels[i]
            if level < FREQUENT:
                missing += 1
                if level:
                    found.add(value)
            else:
                members = classes.setdefault(value % count, [])
                members.append(value)
                missing += len(members) > 1
        for members in classes.values():
            for x, y in combinations(sorted(members), 2):
                found.add((x * 0x9E3779B97F4A7C15 + y * 0xC2B2AE3D27D4EB4F + band) & 0xFFFFFFFFFFFFFFFF)
    return list(found)


def sketch_of(hashes: np.ndarray) -> bytes:
    """Parity of the number of members by bit; sets differ in at least as many members as bits."""
    return np.packbits(np.bincount((hashes % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1).tobytes()


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def index_entries(blocks: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document: its set's size and fingerprint, and what joins need if it may link.

    ``alone`` tells that no other set can link, and equal none. Within a block, equal sets have
    their signatures in the first of them only.
    """
    ranges = repeats.range_count(blocks, 1 / 6)
    words, link, parts = rule

    def counts_of(block: repeats.Block) -> tuple[np.ndarray, np.ndarray]:
        sets = shingle_sets(block, words)
        keys = np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(64 - KEY_BITS)
        del sets
        arrays.release_memory()
        return np.unique(keys, return_counts=True)

    def entries(mine: pa.Table, told: pa.Table) -> pa.Table:
        arrays.release_memory()
        block = repeats.Block(mine)
        sets = shingle_sets(block, words)
        keys = np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(64 - KEY_BITS)
        unique, place = np.unique(keys, return_inverse=True)
        levels = repeats.levels_of(told, unique, ranges, KEY_BITS)[place]
        out: dict[str, list] = {c: [] for c in ("fp_a", "fp_b", "alone", "sigs", "sketch", "hashes")}
        seen, at = set(), 0
        for hashes in sets:
            n, level = len(hashes), levels[at : at + len(hashes)]
            at += n
            fingerprint = (
                int(np.bitwise_xor.reduce(arrays.mixed(hashes))) if n else 0,
                int(hashes.sum(dtype=np.uint64)) if n else 0,
            )
            allowed = fewest_missing(n, link, parts)
            alone = n == 0 or int((level == 0).sum()) > allowed
            first = not alone and (n, fingerprint) not in seen
            seen.add((n, fingerprint))
            # smaller sets (up to eight members at 0.9) only link with equal ones
            links_others = (parts - link) * n >= link
            sigs = signatures(hashes, level, allowed, bands_of(n, link, parts)) if first and links_others else []
            out["fp_a"].append(fingerprint[0])
            out["fp_b"].append(fingerprint[1])
            out["alone"].append(alone)
            out["sigs"].append(_signed(np.array(sigs, np.uint64)))
            out["sketch"].append(sketch_of(hashes) if first else None)
            out["hashes"].append(hashes.astype("<u8").tobytes() if first else None)
        return pa.table(
            {
                "row": pa.array(block.rows(), pa.int64()),
                "doc_id": pa.array(block.ids, pa.int64()),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "fp_a": pa.array(_signed(np.array(out["fp_a"], np.uint64)), pa.int64()),
                "fp_b": pa.array(_signed(np.array(out["fp_b"], np.uint64)), pa.int64()),
                "alone": pa.array(out["alone"], pa.bool_()),
                "sigs": pa.array(out["sigs"], pa.list_(pa.int64())),
                "sketch": pa.array(out["sketch"], pa.binary()),
                "hashes": pa.array(out["hashes"], pa.binary()),
            }
        )

    told = repeats.ask_levels(blocks, "shingles", counts_of, ranges, KEY_BITS)
    met = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(entries, _ENTRY)
    entries = stored(met, "entries")
    drop(told)
    return entries


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The pairs (a, b) whose sets link; ``sets`` has ``row``, ``n``, ``sketch`` and ``hashes``."""
    x = sets.select(F.col("row").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    y = sets.select(F.col("row").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    narrow = pairs.join(x, "a").join(y, "b")
    _, least, parts = rule

    def may_link(batches):
        for batch in batches:
            a = np.frombuffer(b"".join(batch.column("sketch_a").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            b = np.frombuffer(b"".join(batch.column("sketch_b").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
            size = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            # members that differ, d: parts * (size - d) / 2 >= link * (size + d) / 2
            kept = np.flatnonzero((parts - least) * size >= (parts + least) * differ)
            yield batch.select(["a", "b"]).take(pa.array(kept))

    def link(batches):
        for batch in batches:
            kept = []
            for i, (a, b) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                a, b = np.frombuffer(a.as_py(), "<u8"), np.frombuffer(b.as_py(), "<u8")
                shared = len(np.intersect1d(a, b, assume_unique=True))
                if parts * shared >= least * (len(a) + len(b) - shared):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    close = narrow.mapInArrow(may_link, "a long, b long")
    full = close.join(sets.select(F.col("row").alias("a"), F.col("hashes").alias("set_a")), "a")
    full = full.join(sets.select(F.col("row").alias("b"), F.col("hashes").alias("set_b")), "b")
    return full.mapInArrow(link, "a long, b long")


def _near(n_a: str, n_b: str, rule: Rule):
    """Can sets of these sizes link at all?"""
    return rule.parts * F.least(n_a, n_b) >= rule.link * F.greatest(n_a, n_b)


def _close_in_bucket(
    rows: np.ndarray, sizes: np.ndarray, labels: np.ndarray, sketches: np.ndarray, left: np.ndarray, rule: Rule
):
    """Pairs of places, one from ``left`` and one from the rest (or both, where all are left), that may link."""
    _, link, parts = rule
    first = np.flatnonzero(left)
    other = first if len(first) == len(rows) else np.flatnonzero(~left)
    for start in range(0, len(first), 64):
        part = first[start : start + 64]
        differ = np.bitwise_count(sketches[part, None] ^ sketches[None, other]).sum(axis=2, dtype=np.int64)
        size = sizes[part, None] + sizes[None, other]
        smaller = np.minimum(sizes[part, None], sizes[None, other])
        near = (parts - link) * size >= (parts + link) * differ
        near &= parts * smaller >= link * (size - smaller)
        near &= labels[part, None] != labels[None, other]
        at = np.nonzero(near)
        yield rows[part[at[0]]], rows[other[at[1]]]


def close_pairs(now: DataFrame, sets: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Pairs (a, b) of different labels that share a signature and whose sketches allow a link.

    Buckets are compared inside tasks, which hand on only what the sketches leave. A bucket beyond
    ``TILE_ROWS`` is cut by a hash, and every pair of cuts meets in a place of its own.
    """
    tiles = now.groupBy("sig").agg(F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("tiles"))
    rows = now.join(tiles, "sig").withColumn("tile", F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    low, high = F.least("tile", "other"), F.greatest("tile", "other")
    rows = rows.select("sig", "row", "n", "label", "tile", low.alias("low"), high.alias("high"))
    tasks = max(1, rows.count() // TASK_ROWS)
    placed = rows.withColumn("task", F.pmod(F.xxhash64("sig", "low", "high"), F.lit(tasks)))
    placed = placed.join(sets.select("row", "sketch"), "row")

    def meet(table: pa.Table) -> pa.Table:
        arrays.release_memory()
        column = {c: table.column(c).to_numpy() for c in ("sig", "low", "high", "tile", "row", "n", "label")}
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(column["row"]), -1)
        order = np.lexsort((column["high"], column["low"], column["sig"]))
        column = {c: v[order] for c, v in column.items()}
        sketches = sketches[order]
        new = np.zeros(len(order), bool)
        for c in ("sig", "low", "high"):
            new[1:] |= column[c][1:] != column[c][:-1]
        ends = [0, *np.flatnonzero(new).tolist(), len(order)]
        found = [np.zeros((0, 2), np.int64)]
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            left = column["tile"][a:b] == column["low"][a]
            if column["low"][a] != column["high"][a] and left.all():
                continue  # nothing in the other cut
            parts = column["row"][a:b], column["n"][a:b], column["label"][a:b], sketches[a:b], left
            for x, y in _close_in_bucket(*parts, rule):
                found.append(np.column_stack([np.minimum(x, y), np.maximum(x, y)]))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return placed.groupBy("task").applyInArrow(meet, "a long, b long").distinct()


def link_classes(entries: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``row`` and ``label``, the same for rows of the same class, of entries that may link.

    Equal sets become one. Buckets of equal signatures are tested against one of their members
    (a hub) for some rounds, a different one in each, so that large groups of near copies grow
    together with as many tests as they have members. Members of one class need no further test;
    pairs of different classes that share a signature are all compared in the last round.
    """
    some = entries.filter("NOT alone")
    equal = some.groupBy("fp_a", "fp_b", "n").agg(F.min("row").alias("label"))
    members = stored(
        some.select("row", "fp_a", "fp_b", "n").join(equal, ["fp_a", "fp_b", "n"]).select("row", "label"), "members"
    )
    lead = members.filter("row = label").select("row")
    sets = stored(some.filter(F.size("sigs") > 0).join(lead, "row", "left_semi"), "sets")
    by_sig = sets.select("row", "n", F.explode("sigs").alias("sig"))
    shared = by_sig.groupBy("sig").agg(F.count("*").alias("c")).filter("c > 1").select("sig")
    buckets = stored(by_sig.join(shared, "sig", "left_semi"), "buckets")
    labels = stored(buckets.select("row").distinct().withColumn("label", F.col("row")), "labels")
    tested, used = None, [sets, buckets]
    for turn in range(HUB_ROUNDS + 1):
        last = turn == HUB_ROUNDS
        now = buckets.join(labels, "row")
        mixed = now.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
        now = stored(now.join(mixed.select("sig"), "sig", "left_semi"), "open")
        if now.isEmpty():
            drop(now)
            break
        if last:
            pairs = close_pairs(now, sets, rule)
        else:
            order = F.struct(F.xxhash64("row", F.lit(turn)).alias("o"), "row", "n", "label")
            hub = now.groupBy("sig").agg(F.min(order).alias("h")).select("sig", "h.row", "h.n", "h.label")
            hub = hub.select("sig", *[F.col(c).alias(f"{c}_2") for c in ("row", "n", "label")])
            met = now.join(hub, "sig").filter((F.col("label") != F.col("label_2")) & _near("n", "n_2", rule))
            pairs = met.select(F.least("row", "row_2").alias("a"), F.greatest("row", "row_2").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        drop(now)
        used.append(pairs)
        tested = pairs if tested is None else tested.union(pairs)
        links = verified(pairs, sets, rule)
        ends = [labels.select(F.col("row").alias(c), F.col("label").alias(f"l_{c}")) for c in ("a", "b")]
        edges = stored(
            links.join(ends[0], "a").join(ends[1], "b").select(F.col("l_a").alias("a"), F.col("l_b").alias("b")).distinct(),
            "links",
        )
        if not edges.isEmpty():
            before, moved = labels, roots(edges)
            to = moved.select(F.col("node").alias("label"), "root")
            labels = labels.join(to, "label", "left").select("row", F.coalesce("root", "label").alias("label"))
            labels = stored(labels, "labels")
            drop(before, moved)
        drop(edges)
    drop(*used)
    final = labels.select(F.col("row").alias("label"), F.col("label").alias("top"))
    classes = stored(members.join(final, "label", "left").select("row", F.coalesce("top", "label").alias("label")), "classes")
    drop(members, labels)
    return classes


def join_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    words: int = SHINGLE_WORDS, link: int = LINK, parts: int = PARTS,
) -> DataFrame:
    """One row per document: its number of shingles and the smallest id in its class.

    Classes are the connected components of documents whose sets of shingles of ``words`` words
    (lower-cased A-Z, words as runs of characters other than space and \\x09-\\x0D) have a Jaccard
    similarity of ``link / parts`` or more, which must be above the root of a half. No pair within the threshold is missed: document frequencies of all shingles over
    all documents order the members of a set, prefixes give signatures, and every candidate pair of
    different classes is verified on whole sets of 64-bit hashes.

    A null or empty text has an empty set and is linked with nothing; fewer words than a
    shingle's are one shingle. Rows with the same id are judged each for itself. A null id does not count as smallest;
    a class of null ids only has a null ``component_id``. An empty table gives no rows. Other
    columns are ignored.
    """
    blocks = repeats.pack_blocks(docs, id_column, text_column, BLOCK_BYTES)
    classes = block_classes(blocks, Rule(words, link, parts))
    drop(blocks)
    return classes


def block_classes(blocks: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The same for packed documents; of the tables on the way only those of one row a document stay."""
    if 2 * rule.link**2 <= rule.parts**2:
        raise ValueError("signatures need a similarity above the root of a half")
    entries = index_entries(blocks.drop("rest"), rule)
    classes = link_classes(entries, rule)
    ids = stored(entries.select("row", "doc_id", "n"), "ids")
    drop(entries)
    within = classes.join(ids, "row")
    least = within.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = classes.join(least, "label").select("row", "component_id", "label")
    alone = F.col("label").isNull()
    joined = ids.join(linked, "row", "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("label", "row").alias("class"), "row",
    )


def one_per_class(
    docs: DataFrame, columns: tuple[str, ...], id_column: str = "doc_id", text_column: str = "text",
    words: int = SHINGLE_WORDS, link: int = LINK, parts: int = PARTS,
) -> DataFrame:
    """The document with the smallest id of every class (the last choice is a null id), whole.

    ``columns`` come back as they were; of rows with the same id in one class, one stays. Documents
    with an empty set stay.
    """
    types = dict(docs.dtypes)
    blocks = repeats.pack_blocks(docs, id_column, text_column, BLOCK_BYTES, keep=columns)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    classes = block_classes(blocks, Rule(words, link, parts))
    chosen = classes.groupBy("class").agg(F.min(order).alias("best")).select("best.row")
    chosen = stored(chosen, "chosen")

    def unpack(block: repeats.Block, decided: pa.Table) -> pa.Table:
        at = np.sort(decided.column("row").to_numpy()) - block.rows()[0]
        return block.rest(columns).take(pa.array(at))

    return repeats.by_block(blocks, chosen, unpack, ", ".join(f"`{c}` {types[c]}" for c in columns))
