"""Exact n-gram Jaccard self-join by universe partition, and the groups its links form.

Every text becomes the set of its distinct word n-grams (64-bit hashes); equal
sets are one class, so copies are never paired with each other.

*Signatures.* Classes fall into size bands. In a band, two linked sets differ in
at most ``H`` n-grams. The universe is dealt into ``m`` segments by a hash; a
segment is allocated 0 (its content must agree) or 1 (it may differ by one
n-gram, so its one-deletion neighbourhood is indexed too). If the allocations of
the non-empty segments, plus one each, add up to more than ``H``, some segment of
a linked pair must agree within its allocation. Where all are allocated 0 there is
a segment more than that takes, so two must agree: a pair with one agreement
only is dropped before any sketch travels. ``plan`` picks the cheapest
allocation for a band from its number of classes. A set whose non-empty segments
don't add up also takes part in the next of a family of partitions; as one
non-deficient side is enough, no pair is lost. A class also signs in a lower band
if a linked partner can lie there.

*Candidates.* Signatures travel as packed arrays to buckets; those that occur once
end there. Small groups of classes with equal signatures give pairs, crowded ones
stay membership lists.

*Verification.* A parity sketch of as many bits as the set has n-grams (1,024 at least)
bounds the difference of two sets from below, which drops most pairs without touching the
sets; a longer sketch is folded to the length of a shorter one. The rest is
compared exactly, in two rounds. First each class meets its nearest neighbour, and the
classes of a crowd their centre: the one whose sketch is nearest to the bitwise majority of
the crowd's sketches, which is where copies of one text come from. What then lies in
different components is compared: pairs of small groups as they are, of a crowd the
classes outside its largest component with all others, in blocks of about ``BLOCK`` by
``BLOCK`` that any task can take; crowds of the same classes are compared as one. A block holds the exact sets of the classes that sketches leave undecided,
verifies only pairs that are still apart, and hands on the links that join them (fewer than its
classes). Every link that could join two components is therefore verified, while pairs inside a component
aren't emitted. No step holds a crowd whole but that which deals signatures, as two numbers for each class.

Defined results: null, empty and blank texts have an empty set, link with nothing
and are their own component; with fewer than ``n`` words the whole sequence is the
only n-gram; rows that repeat an id or a text get equal results; a null id takes
part but never names a component unless all its ids are null. Only id and text
are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import free_name, mix64, stage, table, then_give_back

RATIO = 1.5  # of a size band's ends
SKETCH_BITS = 1024  # at least; large sets have more
MOST_SKETCH_BITS = 1 << 15
CROWD = 48  # classes with an equal signature that are paired at once
BLOCK = 512  # classes of a crowded group compared with as many others in one task
FLUSH = 500_000  # signatures a task gathers before it hands them on
CANDIDATE = 2  # bytes of a chance agreement, two ids written and shuffled, by those of a signature with its share of an id
AGREE = 2  # segments that have to agree where none may differ
LOW = 40  # n-grams of the sets for which that holds
SINGLE = np.uint64(1 << 24)  # the lowest bit that travels: set in a signature of which one is enough
SIG_BYTES = 5  # of a signature that travel to its bucket
FILTER_BITS = 1 << 26  # at most, of the filter that spares rows the shuffle
ROUNDS = 60
MET = ["sig", "a", "b", "own", "blocks", "weight"]


def bands(most: int) -> Iterator[tuple[int, int, int]]:
    number, low = 0, 1
    while low <= most:
        high = max(low, int(low * RATIO))
        yield number, low, high
        number, low = number + 1, high + 1


def difference(size_a, size_b, percent: int):
    """Most n-grams in which linked sets of these sizes differ: 100 I >= percent U, and I + U is the sum of sizes."""
    return ((100 - percent) * (size_a + size_b)) // (100 + percent)


def needed(h: int, low: int, ones: int) -> int:
    """What a set's allocations, plus one each, have to add up to: so many that ``AGREE`` segments agree if all are allocated 0 (one in short sets)."""
    return h + (AGREE if not ones and low >= LOW else 1)


def plan(high: int, low: int, percent: int, classes: int, shared: float = 0.02) -> tuple[int, int, int]:
    """(H, segments allocated 0, segments allocated 1) of a band, by least cost for a class of mean size.

    Cost: signatures written, plus chance candidates, each as much as ``CANDIDATE`` signatures: with ``shared`` as the
    probability that an unrelated class has an n-gram, segments of ``g`` n-grams agree by chance in ``classes * shared ** g`` cases.
    """
    h = difference(high, (100 * high) // percent, percent)
    size = (low + high) / 2
    best = None
    for ones in sorted({0, 1, (h + 1) // 4, (h + 1) // 2, (h + 2) // 2}):
        least = needed(h, low, ones)
        zeros = max(0, least - 2 * ones)
        while True:  # room for empty segments at the band's low end
            m = zeros + ones
            used = m * (1 - (1 - 1 / m) ** low) if m > 1 else float(m)
            if used * (zeros + 2 * ones) / m >= least - 1e-9 or m >= 4 * (h + 1) or m >= 2 * low + 2:
                break
            if ones and not zeros:
                ones += 1
            else:
                zeros += 1
        g = size / m
        signatures = zeros + ones * (1 + g)
        chance = classes * (zeros * shared ** g + ones * (1 + g) * shared ** max(g - 1, 0))
        cost = signatures + CANDIDATE * chance
        if best is None or cost < best[0]:
            best = (cost, h, zeros, ones)
    return best[1:]


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; A-Z count as a-z."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    width = min(n, len(h))
    key = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - width + 1 + j])
    return np.unique(key)


def class_id(s: np.ndarray) -> int:
    """64-bit hash of the set, in which every n-gram has a part."""
    with np.errstate(over="ignore"):
        both = mix64(s ^ np.uint64(0x1234567)).sum(dtype=np.uint64) ^ mix64(s.sum(keepdims=True, dtype=np.uint64))[0]
    return int(mix64(np.array([both + np.uint64(len(s))]))[0].view(np.int64))


def sketch_bits(size: int) -> int:
    return min(MOST_SKETCH_BITS, max(SKETCH_BITS, 1 << max(0, size - 1).bit_length()))


def sketch(s: np.ndarray) -> bytes:
    """Parity sketch: an n-gram in one of two sets flips one bit, so differing bits are at most differing n-grams."""
    bits = sketch_bits(len(s))
    at = ((mix64(s ^ np.uint64(0x5EED)) >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1).tobytes()


def signatures(s: np.ndarray, percent: int, plans: dict[int, tuple[int, int, int]]) -> np.ndarray:
    out = []
    size = len(s)
    with np.errstate(over="ignore"):
        for band, low, high in band_list(size):
            if high * 100 < percent * size:
                continue  # no partner of this size there
            h, zeros, ones = plans[band]
            m, least, first = zeros + ones, needed(h, low, ones), len(out)
            for family in range(64):
                salt = np.uint64((band * 64 + family) * 2 + 1) * np.uint64(0xD6E8FEB86659FD93)
                g = mix64(s ^ salt)
                seg = (g % np.uint64(m)).astype(np.int64)
                order = np.argsort(seg, kind="stable")
                seg, body = seg[order], mix64(g[order] + np.uint64(77))
                starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
                count = np.diff(np.r_[starts, len(seg)])
                total = np.add.reduceat(body, starts)
                used = seg[starts]
                out.append(mix64(total ^ (used.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + salt)))
                loose = (used >= zeros) & (count >= 2)
                if loose.any():
                    mine = np.repeat(loose, count)
                    less = np.repeat(total, count)[mine] - body[mine]
                    out.append(mix64(less ^ (seg[mine].astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + salt)))
                if len(used) + int(loose.sum()) >= least:
                    alone = len(out)
                    break  # not deficient: a linked partner in this family is sure to be met
            else:  # deficient in all: two such sets meet by an n-gram they share
                alone = len(out)
                out.append(mix64(s ^ np.uint64(2 * band + 2) * np.uint64(0xD6E8FEB86659FD93)))
            if least == h + 1:
                alone = first
            out[first:] = [x & ~SINGLE if i < alone else x | SINGLE for i, x in enumerate(out[first:], first)]
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


@lru_cache(maxsize=4096)
def band_list(size: int) -> tuple[tuple[int, int, int], ...]:
    return tuple(bands(size))


class Join:
    """The steps of one join; ``percent`` is the least similarity, ``n`` the words of an n-gram."""

    def __init__(self, docs: DataFrame, n: int, percent: int, id_col: str, text_col: str):
        self.n, self.percent = n, percent
        self.docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        self.parts = max(1, self.docs.rdd.getNumPartitions())

    def classes_of_documents(self) -> DataFrame:
        """(id, size, cid, sketch) of every row."""
        n = self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = (shingles(t, n) for t in batch.column(1).cast(pa.binary()).to_pylist())
                rows = [(len(s), class_id(s), sketch(s)) for s in sets]
                size, cid, sk = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size, pa.int64()), pa.array(cid, pa.int64()), pa.array(sk, pa.binary())],
                    ["id", "size", "cid", "sketch"])

        kind = self.docs.schema["id"].dataType.simpleString()
        return self.docs.mapInArrow(then_give_back(run), f"id {kind}, size long, cid long, sketch binary")

    def shared_signatures(self, plans: dict[int, tuple[int, int, int]]) -> DataFrame:
        """(a, b, weight) of classes that share signatures; where a crowd does, (sig, a) with a's block and the crowd's number of blocks.

        A pair's weights add up to ``AGREE`` at least if it may be linked and shares no crowd.
        """
        # a partition's texts have more signatures than words to spare: several buckets for each, so that one fits a task
        n, percent, buckets = self.n, self.percent, 4 * self.parts

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sigs, cids, size, seen = [], [], 0, set()

            def flush() -> pa.RecordBatch:
                sig = np.concatenate(sigs)
                cid = np.repeat(np.array(cids, np.int64), [len(x) for x in sigs])
                bucket = (sig % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                rows = []
                for b in range(buckets):
                    mine = order[cuts[b]:cuts[b + 1]]
                    if len(mine):  # a class's signatures stand together: its id once, with their number
                        heads = np.flatnonzero(np.r_[True, cid[mine][1:] != cid[mine][:-1]])
                        rows.append((b, _short(sig[mine]), np.diff(np.r_[heads, len(mine)]).astype("<u4").tobytes(), cid[mine][heads].tobytes()))
                b, x, y, z = zip(*rows, strict=True)
                return pa.RecordBatch.from_arrays(
                    [pa.array(b, pa.int32()), *(pa.array(c, pa.binary()) for c in (x, y, z))], ["bucket", "sig", "count", "cid"])

            for batch in batches:
                for text in batch.column(0).cast(pa.binary()).to_pylist():
                    s = shingles(text, n)
                    if not len(s) or (cid := class_id(s)) in seen:  # copies within these batches sign once
                        continue
                    seen.add(cid)
                    sigs.append(signatures(s, percent, plans))
                    cids.append(cid)
                    size += len(sigs[-1])
                    if size >= FLUSH:
                        yield flush()
                        sigs, cids, size = [], [], 0
                        if len(seen) > 1_000_000:
                            seen.clear()
            if size:
                yield flush()

        def meet(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sig, cid, single = [], [], SINGLE >> np.uint64(64 - 8 * SIG_BYTES)
            for batch in batches:
                for x, y, z in zip(*(batch.column(c).to_pylist() for c in ("sig", "count", "cid")), strict=True):
                    sig.append(_long(x))
                    cid.append(np.repeat(np.frombuffer(z, np.int64), np.frombuffer(y, "<u4")))
            sig, cid = np.concatenate(sig), np.concatenate(cid)
            order = np.lexsort((cid, sig))
            sig, cid = sig[order], cid[order]
            new = np.r_[True, (sig[1:] != sig[:-1]) | (cid[1:] != cid[:-1])]
            sig, cid = sig[new], cid[new]
            starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
            count = np.diff(np.r_[starts, len(sig)])
            crowd = np.repeat(count > CROWD, count)
            if crowd.any():
                place = np.arange(len(sig)) - np.repeat(starts, count)
                named = sig[crowd] * np.uint64(buckets) + np.uint64(key[0].as_py())  # of one bucket only
                yield pa.RecordBatch.from_arrays(
                    [pa.array(named.view(np.int64)), pa.array(cid[crowd]), pa.nulls(int(crowd.sum()), pa.int64()),
                     pa.array((place[crowd] // BLOCK).astype(np.int32)), pa.array(np.repeat(-(-count // BLOCK), count)[crowd].astype(np.int32)),
                     pa.nulls(int(crowd.sum()), pa.int32())], MET)
            for length in np.unique(count[(count > 1) & (count <= CROWD)]):
                first, second = np.triu_indices(int(length), 1)
                heads = starts[count == length]
                step = max(1, FLUSH // len(first))
                for i in range(0, len(heads), step):
                    a = cid[(heads[i:i + step, None] + first).ravel()]
                    b = cid[(heads[i:i + step, None] + second).ravel()]
                    weight = np.repeat(np.where(sig[heads[i:i + step]] & single, AGREE, 1), len(first))
                    order = np.lexsort((b, a))
                    a, b = a[order], b[order]
                    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
                    weight = np.minimum(np.add.reduceat(weight[order], new), AGREE).astype(np.int32)
                    a, b = a[new], b[new]
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b), pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int32()),
                         pa.array(weight)], MET)

        packed = self.docs.select("text").mapInArrow(then_give_back(sign), "bucket int, sig binary, count binary, cid binary")
        return packed.groupBy("bucket").applyInArrow(_grouped(meet), "sig long, a long, b long, own int, blocks int, weight int")

    def near(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """Those (a, b) that sizes and sketches don't rule out, with the sketches' distance."""
        percent = self.percent
        side = lambda x: classes.select(F.col("cid").alias(x), F.col("size").alias(f"size_{x}"), F.col("sketch").alias(f"sketch_{x}"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                m, k = (batch.column(f"size_{c}").to_numpy() for c in "ab")
                d = _apart(*(batch.column(f"sketch_{c}").to_pylist() for c in "ab"))
                ok = pa.array(d <= difference(m, k, percent))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(d)], ["a", "b", "d"]).filter(ok)

        return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(then_give_back(run), "a long, b long, d long")

    def sets_of(self, cids: DataFrame, classes: DataFrame) -> DataFrame:
        """(cid, set) of the classes named, from one document of each."""
        n = self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    sets = [shingles(t, n) for t in batch.column(0).slice(at, 500).cast(pa.binary()).to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([class_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["cid", "body"])

        ids = classes.join(cids, "cid", "left_semi").select("id")
        return self.docs.join(ids, self.docs["id"].eqNullSafe(ids["id"]), "left_semi").select("text") \
            .mapInArrow(then_give_back(run), "cid long, body binary").dropDuplicates(["cid"])

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        percent = self.percent
        side = lambda x: sets.select(F.col("cid").alias(x), F.col("body").alias(f"set_{x}"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok = [_linked(x, y, percent) for x, y in zip(*(batch.column(f"set_{c}").to_pylist() for c in "ab"), strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

        return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(then_give_back(run), "a long, b long")

    def around_centres(self, crowds: DataFrame) -> DataFrame:
        """(a, b) of each class with the centre of the largest crowd it is in, from tallies of the crowds' sketch bits by block."""
        each = _each(crowds, "a", "sketch")

        def tally(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            bits = np.unpackbits(_bits(table.column("sketch").to_pylist()).view(np.uint8), axis=1)
            return pa.table([pa.array([key[0].as_py()], pa.int64()), table.column("blocks").slice(0, 1), pa.array([table.num_rows], pa.int64()),
                             pa.array([bits.sum(axis=0, dtype="<u4").tobytes()], pa.binary())], ["sig", "blocks", "n", "counts"])

        def majority(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, counts, blocks = 0, np.zeros(SKETCH_BITS, np.int64), None
            for batch in batches:
                n += sum(batch.column("n").to_pylist())
                counts += sum(np.frombuffer(x, "<u4").astype(np.int64) for x in batch.column("counts").to_pylist())
                blocks = batch.column("blocks").slice(0, 1)
            middle = np.packbits(2 * counts > n).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), blocks, pa.array([middle], pa.binary())], ["sig", "blocks", "middle"])

        def nearest(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            middle = [x for x in table.column("middle").to_pylist() if x is not None]
            table = table.filter(pa.compute.is_valid(table.column("a")))
            a = table.column("a").to_numpy()
            d = np.bitwise_count(_bits(table.column("sketch").to_pylist()) ^ _bits(middle[:1])).sum(axis=1).astype(np.int64)
            best = np.lexsort((a, d))[:1]
            return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array(a[best]), pa.array(d[best])], ["sig", "a", "d"])

        block = ["sig", "own"]
        middles = each.repartition(*block).groupBy(*block).applyInArrow(tally, "sig long, blocks int, n long, counts binary") \
            .groupBy("sig").applyInArrow(majority, "sig long, blocks int, middle binary") \
            .select("sig", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own"), "middle")
        both = each.select("sig", "own", "a", "sketch").unionByName(middles, allowMissingColumns=True)
        centres = both.repartition(*block).groupBy(*block).applyInArrow(nearest, "sig long, a long, d long") \
            .groupBy("sig").agg(F.min(F.struct("d", "a"))["a"].alias("c"))
        largest = F.array_max(F.transform("places", lambda p: F.struct(p["blocks"], p["sig"])))["sig"]
        return crowds.select("a", largest.alias("sig")).join(centres, "sig").filter("a <> c") \
            .select(F.least("a", "c").alias("a"), F.greatest("a", "c").alias("b")).distinct()

    def split_crowds(self, crowds: DataFrame, labels: DataFrame) -> DataFrame:
        """(sig, major, a, label, n, minors) of the classes of crowds that lie in several components; ``major`` names the largest.

        Copies of one text share many crowds, so a pair would be compared once in each. Crowds with one ``major`` are
        taken together (sig 0), each class once, unless they overlap so little that this means more comparisons.
        """
        named = crowds.join(labels, F.col("a") == F.col("node"), "left").withColumn("label", F.coalesce("label", "a")).drop("node")
        each = _each(named, "a", "label")
        # groups of one component have nothing left to compare
        alone = each.groupBy("sig", "label").agg(F.count("*").alias("n"), F.max("blocks").alias("blocks")).groupBy("sig") \
            .agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n"), F.max("blocks").alias("blocks")).filter("n > most.n") \
            .select("sig", F.col("most.label").alias("major"), "n", (F.col("n") - F.col("most.n")).alias("minors"), "blocks")
        # a crowd meets its figures block by block: by signature alone it would be one task's
        member = each.join(alone.withColumn("own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks"), ["sig", "own"])
        member = stage(member.select("sig", "major", "a", "label", "n", "minors"), "crowd-members")
        once = member.groupBy("major", "a").agg(F.first("label").alias("label"))
        apart = member.groupBy("major", "sig").agg(F.first(F.col("n") * F.col("minors")).alias("compared")).groupBy("major").agg(F.sum("compared").alias("compared"))
        together = once.groupBy("major").agg(F.count("*").alias("n"), F.count_if(F.col("label") != F.col("major")).alias("minors")) \
            .join(apart, "major").filter(F.col("n") * F.col("minors") <= F.col("compared")).drop("compared")
        return member.join(together, "major", "left_anti").unionByName(once.join(together, "major").withColumn("sig", F.lit(0).cast("bigint")))

    def crowded_links(self, crowds: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
        """Links (a, b) between components of a crowd: of its classes outside the largest component with all others."""
        percent = self.percent
        keep = ["sig", "major", "i", "j", "side", "a", "size", "sketch", "label", "minor"]
        kind = "sig long, major long, i int, j int, side int, a long, size long, sketch binary, label long, minor boolean"
        split = self.split_crowds(crowds, labels).join(crowds.select("a", "size", "sketch"), "a")
        # classes as rows (side 0, outside the largest component) and columns (side 1, all) of the comparison, about BLOCK by BLOCK at once
        up_to = lambda n: F.sequence(F.lit(0), F.ceil(F.col(n) / BLOCK).cast("int") - 1)
        place = lambda n, salt: F.pmod(F.xxhash64("a", F.lit(salt)), F.ceil(F.col(n) / BLOCK)).cast("int")
        cell = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
        as_row = F.when(F.col("minor"), F.transform(up_to("n"), lambda j: cell(F.col("row"), j, 0)))
        as_column = F.transform(up_to("minors"), lambda i: cell(i, F.col("column"), 1))
        cells = F.concat(F.coalesce(as_row, F.slice(as_column, 1, 0)), as_column)

        def feasible(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            """(row on the left, rows on the right, distances) that neither component nor sketch rules out."""
            a, size, label, side = (table.column(c).to_numpy() for c in ("a", "size", "label", "side"))
            minor = np.array(table.column("minor"), bool)
            sketches = table.column("sketch").to_pylist()
            bits = _bits(sketches, 8 * min(map(len, sketches)))
            right = np.flatnonzero(side == 1)
            for x in np.flatnonzero(side == 0):
                ys = right[(label[right] != label[x]) & (~minor[right] | (a[right] > a[x]))]
                d = np.bitwise_count(bits[ys] ^ bits[x]).sum(axis=1)
                ok = d <= difference(size[ys], size[x], percent)
                if ok.any():
                    yield x, ys[ok], d[ok]

        def undecided(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            use = np.zeros(table.num_rows, bool)
            for x, ys, _ in feasible(table):
                use[x] = use[ys] = True
            return table.select(keep).filter(pa.array(use))

        def verify(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            a, label, body = table.column("a").to_numpy(), table.column("label").to_pylist(), table.column("body").to_pylist()
            parent = {x: x for x in label}

            def find(x: int) -> int:
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            found = []
            every = [(x, ys, d) for x, ys, d in feasible(table)]
            d = np.concatenate([d for _, _, d in every] or [np.zeros(0, np.int64)])
            xs = np.repeat([x for x, _, _ in every], [len(ys) for _, ys, _ in every]).astype(np.int64)
            ys = np.concatenate([ys for _, ys, _ in every] or [np.zeros(0, np.int64)])
            for at in np.argsort(d, kind="stable"):  # near ones first: they join most, and what is joined needs no comparison
                x, y = xs[at], ys[at]
                if (one := find(label[x])) != (other := find(label[y])) and _linked(body[x], body[y], percent):
                    parent[one] = other
                    found.append((min(a[x], a[y]), max(a[x], a[y])))
            return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

        # each grouping follows a dealing of its own by all its keys: dealt by crowd alone, all its blocks would be one task's
        block = ["sig", "major", "i", "j"]
        rows = split.withColumns({"minor": F.col("label") != F.col("major"), "row": place("minors", 0), "column": place("n", 1)}) \
            .select("sig", "major", "a", "size", "sketch", "label", "minor", F.explode(cells).alias("cell")) \
            .select("sig", "major", "cell.i", "cell.j", "cell.side", "a", "size", "sketch", "label", "minor")
        left = rows.repartition(*block).groupBy(*block).applyInArrow(undecided, kind)
        whole = stage(left, "undecided").join(sets, F.col("a") == F.col("cid")).drop("cid")
        return whole.repartition(*block).groupBy(*block).applyInArrow(verify, "a long, b long").distinct()


def _each(crowds: DataFrame, *columns: str) -> DataFrame:
    """One row for each crowd that a class is in."""
    return crowds.select(*columns, F.explode("places").alias("p")).select("p.sig", "p.own", "p.blocks", *columns)


def _grouped(fn):
    """``then_give_back`` for a grouped function, whose two arguments applyInArrow looks for."""
    freed = then_give_back(fn)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return freed(key, batches)
    return run


def _short(sig: np.ndarray) -> bytes:
    """The upper ``SIG_BYTES`` of each signature: in a bucket a few chance agreements more, which the sketches tell apart."""
    return np.ascontiguousarray((sig >> np.uint64(64 - 8 * SIG_BYTES)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SIG_BYTES]).tobytes()


def _long(body: bytes) -> np.ndarray:
    out = np.zeros((len(body) // SIG_BYTES, 8), np.uint8)
    out[:, :SIG_BYTES] = np.frombuffer(body, np.uint8).reshape(-1, SIG_BYTES)
    return out.view("<u8").ravel().astype(np.uint64)


def _bits(sketches: list[bytes], bits: int = SKETCH_BITS) -> np.ndarray:
    """The sketches folded to ``bits`` bits: n-grams of bits that fall together cancel out, as in a sketch of that length."""
    out = np.zeros((len(sketches), bits // 64), np.uint64)
    sizes = np.fromiter(map(len, sketches), np.int64, len(sketches))
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        out[mine] = np.bitwise_xor.reduce(np.frombuffer(b"".join([sketches[i] for i in mine]), np.uint64).reshape(len(mine), -1, bits // 64), axis=1)
    return out


def _apart(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Differing bits of each pair of sketches, at the length of the shorter."""
    sizes = np.fromiter((min(len(a), len(b)) for a, b in zip(x, y, strict=True)), np.int64, len(x))
    out = np.zeros(len(x), np.int64)
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        for i in range(0, len(mine), 2000):
            some = mine[i:i + 2000]
            out[some] = np.bitwise_count(_bits([x[j] for j in some], 8 * int(size)) ^ _bits([y[j] for j in some], 8 * int(size))).sum(axis=1)
    return out


def _linked(x: bytes, y: bytes, percent: int) -> bool:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, by alternating large-star and small-star rounds.

    Each round's edges are written to the shared folder; it ends when a round changes nothing.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    sign = None
    for _ in range(ROUNDS):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = stage(small.filter("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == sign:
            break
        sign = now
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``."""
    join = Join(docs, n, percent, id_col, text_col)
    rows = stage(join.classes_of_documents(), "members")
    classes = stage(rows.filter("size > 0").groupBy("cid")
                    .agg(F.min("id").alias("id"), F.first("size").alias("size"), F.first("sketch").alias("sketch")), "classes")
    most = classes.agg(F.max("size")).first()[0] or 0
    known = list(bands(most))
    edge = F.array(*[F.lit(low) for _, low, _ in known]) if known else F.array().cast("array<int>")
    per_band = {r["band"]: r["count"] for r in classes.groupBy(
        (F.size(F.filter(edge, lambda low: low <= F.col("size"))) - 1).alias("band")).count().collect()}  # a row for each band
    plans = {b: plan(high, low, percent, per_band.get(b, 0)) for b, low, high in known}
    met = stage(join.shared_signatures(plans), "signatures")
    # one row for each class, however many crowds it is in (no more than it has signatures)
    crowds = stage(met.filter("b is null").groupBy("a").agg(F.collect_list(F.struct("sig", "own", "blocks")).alias("places"))
                   .join(classes.select(F.col("cid").alias("a"), "size", "sketch"), "a"), "crowds")
    around = stage(join.around_centres(crowds), "around")
    agreeing = met.filter("b is not null").select("a", "b", "weight").unionByName(around.withColumn("weight", F.lit(AGREE))) \
        .groupBy("a", "b").agg(F.sum("weight").alias("weight")).filter(F.col("weight") >= AGREE).select("a", "b")
    near = stage(join.near(agreeing, classes), "near")
    ends = near.select("a", "b", "d").unionAll(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
    nearest = ends.groupBy("a").agg(F.min(F.struct("d", "b"))["b"].alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    one = nearest.unionByName(near.join(around, ["a", "b"], "left_semi").select("a", "b")).distinct()
    named = near.select(F.col("a").alias("cid")).unionAll(near.select(F.col("b").alias("cid"))).unionAll(crowds.select(F.col("a").alias("cid"))).distinct()
    sets = stage(join.sets_of(named, classes), "sets")
    first = stage(join.verified(one, sets), "links-1")
    labels = stage(components(first), "labels")
    far = labels.select(F.col("node").alias("a"), F.col("label").alias("la")), labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    between = near.join(far[0], "a", "left").join(far[1], "b", "left") \
        .filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b").join(one, ["a", "b"], "left_anti")
    second = join.verified(between, sets).unionByName(join.crowded_links(crowds, labels, sets))
    final = components(first.unionByName(second))
    named_by = final.join(classes.select(F.col("cid").alias("node"), "id"), "node").groupBy("label").agg(F.min("id").alias("component"))
    by_class = final.join(named_by, "label").select(F.col("node").alias("cid"), "component") \
        .unionByName(classes.join(final, F.col("cid") == F.col("node"), "left_anti").select("cid", F.col("id").alias("component")))
    return rows.select("id", "size", "cid").join(by_class, "cid", "left") \
        .select("id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` of each component, unchanged: that with the smallest id (of rows that repeat id and text, any)."""
    own = free_name(docs, "row")
    # an id alone may stand in several rows
    keyed = docs.withColumn(own, F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("h")))
    found = jaccard_components(keyed.select(own, text_col), n, percent, own, text_col)
    goes = ~F.col("id").eqNullSafe(F.col("c"))
    doubtful = stage(found.groupBy("id").agg(F.count("*").alias("n"), F.min("component_id").alias("c"))
                     .select("id", goes.alias("goes"), "n").filter("goes or n > 1").select("id", "goes"), "doubtful")
    # few rows go or repeat: only what the filter can't clear is shuffled with its text
    may_go = _filter_of(doubtful.select(F.xxhash64("id.id", "id.h").alias("key")))(F.xxhash64(f"{own}.id", f"{own}.h"))
    gone = doubtful.filter("goes").select(F.col("id").alias(own))
    doubted = keyed.filter(may_go).join(gone, own, "left_anti").dropDuplicates([own])
    return keyed.filter(~may_go).unionByName(doubted).select(*[F.col(f"`{c}`") for c in docs.columns])


def _filter_of(keys: DataFrame):
    """A test of a 64-bit key that is true for all of ``keys`` and few others: a Bloom filter with two bits a key.

    It has 16 bits a key, up to ``FILTER_BITS``; beyond that it clears fewer keys, and a caller's exact join decides more.
    """
    bits = min(FILTER_BITS, max(1 << 10, 1 << (16 * keys.count()).bit_length()))
    low, high = F.col("key").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("key", 32).bitwiseAND(F.lit(bits - 1))
    words = keys.select(F.explode(F.array(low, high)).alias("at")) \
        .groupBy(F.shiftright("at", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 31 as int))")).alias("mask")).toArrow()
    table = np.zeros(bits // 32, np.uint32)
    table[words.column("word").to_numpy()] = words.column("mask").to_numpy().astype(np.uint32)
    sent = keys.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def holds(key: pa.Array) -> pa.Array:
        table, key = sent.value, key.to_numpy(zero_copy_only=False).view(np.uint64)
        out = np.ones(len(key), bool)
        for at in (key & np.uint64(bits - 1), (key >> np.uint64(32)) & np.uint64(bits - 1)):
            out &= (table[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1
        return pa.array(out)

    return holds


def op10_jaccard_join(spark, sf_dir: str) -> DataFrame:
    out = jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)
    return out.withColumnRenamed("id", "doc_id")
