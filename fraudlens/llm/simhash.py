"""SimHash near-duplicates found through the Golay code.

A fingerprint is cut into three segments of at most 23 bits.  The perfect (23,12) Golay code maps
a segment to the codewords within four bits of it: one, or six if the nearest is three bits away.
Two segments that differ in at most two bits always share such a codeword: if the nearest
codeword of one is three bits off, the five others partition the remaining positions.  Of at most
two differing bits, one of the three segments has none (pigeonhole) and the next at most two, so
every linked pair shares a key (which segment, its exact bits, a codeword of the next).

Keys are joined, and candidate pairs are compared bit by bit.  A key that more than ``BUCKET``
fingerprints share is left to an exact second way: fingerprints within two bits have a value
in common that is at most one bit from either, and at most 65 fingerprints are that near a
value, so groups stay bounded however large a family of copies is.  Equal fingerprints are
one node throughout, and groups give spanning links, not all pairs.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; repeated
rows get equal results; a null ``doc_id`` keeps its row and is no candidate for the smallest id
(a component without any other has a null id); an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fraudlens.llm.blocks import blocks, documents
from fraudlens.llm.components import components
from fraudlens.session import fresh_path

SHINGLE, MAX_BITS, BUCKET = 3, 2, 64
#: Fixed value: the generator polynomial of the binary Golay code.
GENERATOR = 0b101011100011
#: Low bit and width of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def _remainder(v: int) -> int:
    for bit in range(22, 10, -1):
        if v >> bit & 1:
            v ^= GENERATOR << (bit - 11)
    return v


def _error_patterns() -> np.ndarray:
    """For each remainder the up to six patterns of at most four bits that have it."""
    of: dict[int, list[int]] = {}
    single = [_remainder(1 << b) for b in range(23)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            rest = 0
            for b in bits:
                rest ^= single[b]
            known = of.setdefault(rest, [])
            if weight < 4 or known[0].bit_count() == 3:
                known.append(sum(1 << b for b in bits))
    return np.array([(of[r] + of[r][:1] * 6)[:6] for r in range(2048)], np.int64)


PATTERNS = _error_patterns()
LOW = np.array([_remainder(v) for v in range(1 << 12)], np.int64)
HIGH = np.array([_remainder(v << 12) for v in range(1 << 11)], np.int64)


def codewords(segment: np.ndarray) -> np.ndarray:
    """Indices (the 12 data bits) of the near codewords, six a row, the nearest repeated."""
    rest = LOW[segment & 0xFFF] ^ HIGH[segment >> 12]
    return (segment[:, None] ^ PATTERNS[rest]) >> 11


def keys_of(prints: np.ndarray) -> np.ndarray:
    """Eighteen keys a fingerprint, some of them equal."""
    prints = prints.view(np.uint64)
    parts = [((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    near = [codewords(part) for part in parts]
    return np.concatenate([(i << 34 | parts[i] << 12)[:, None] | near[(i + 1) % 3] for i in range(3)], axis=1)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64 bits that are set in over half of the shingles' hashes."""
    found = text.lower().split()
    if not found:
        return 0
    grams = map(b" ".join, zip(*(found[i:] for i in range(shingle)))) if len(found) >= shingle else [b" ".join(found)]
    total, n = np.zeros(64, np.int64), max(len(found) - shingle + 1, 1)
    hashes = b"".join([xxhash.xxh64_digest(x, 42) for x in grams])
    bits = np.frombuffer(hashes, np.uint8)
    for at in range(0, len(bits), 1 << 16):
        total += np.unpackbits(bits[at : at + (1 << 16)]).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, bits): the fingerprint of each text as a signed long."""
    def run(batches):
        for block in blocks(batches):
            made = np.array([fingerprint(x, shingle) for x in block.texts()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([block.rows.column(0), pa.array(made)], ["doc_id", "bits"])

    return documents(docs).mapInArrow(run, "doc_id long, bits long")


def _with_keys(batches):
    for batch in batches:
        bits = batch.column(0).to_numpy(zero_copy_only=False)
        if len(bits):
            keys = np.sort(keys_of(bits), axis=1)
            fresh = np.ones(keys.shape, bool)
            fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
            row = np.nonzero(fresh)[0]
            yield pa.RecordBatch.from_arrays([pa.array(keys[fresh]), pa.array(bits[row])], ["key", "bits"])


def spanning(members: list[int], max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that join what pairs within ``max_bits`` join."""
    top = list(range(len(members)))

    def root(i: int) -> int:
        while top[i] != i:
            i = top[i]
        return i

    out = []
    for j in range(1, len(members)):
        for i in range(j):
            if ((members[i] ^ members[j]) & (1 << 64) - 1).bit_count() <= max_bits and (a := root(i)) != (b := root(j)):
                top[b] = a
                out.append((members[i], members[j]))
    return out


def _links(max_bits: int):
    def run(batches):
        for batch in batches:
            pairs = [p for group in batch.column(0).to_pylist() for p in spanning(group, max_bits)]
            if pairs:
                a, b = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``bits`` that span every group of near ones."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the code finds pairs of at most two differing bits")
    keyed = prints.select("bits").mapInArrow(_with_keys, "key long, bits long")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = keyed.join(shared, "key")
    small = members.where(F.col("n") <= BUCKET).groupBy("key").agg(F.collect_list("bits").alias("members"))
    found = small.select("members").mapInArrow(_links(max_bits), "a long, b long")
    crowded = members.where(F.col("n") > BUCKET).select("bits").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("bits").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    # with a limit of one bit, or none, the common value is one of the two itself
    near = F.concat(F.array("bits"), flips) if max_bits else F.array("bits")
    spread = crowded.select("bits", F.explode(near).alias("value"))
    family = spread.groupBy("value").agg(F.array_sort(F.collect_set("bits")).alias("members")).where(F.size("members") > 1)
    return found.union(family.select("members").mapInArrow(_links(max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id, bits, component_id`` (smallest ``doc_id`` reachable)."""
    spark = docs.sparkSession
    path = fresh_path(spark, "fingerprints")
    fingerprints(docs, shingle).write.parquet(path)
    rows = spark.read.parquet(path)
    distinct = rows.groupBy("bits").agg(F.min("doc_id").alias("least"))
    joined = components(links(distinct, max_bits))
    labelled = distinct.join(joined, distinct.bits == joined.node, "left").select(
        "bits", "least", F.coalesce("component", "bits").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = labelled.join(smallest, "component").select("bits", "component_id")
    return rows.join(classes, "bits").select("doc_id", "bits", "component_id")


def hex_digits(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents that are the smallest ``doc_id`` of their component, one row of each.

    Same columns.  Rows without ``doc_id`` stay only if no row of their component has one, then
    one row for each distinct text; rows that share the smallest ``doc_id`` likewise.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "classes")
    near_duplicates(docs, shingle, max_bits).withColumn("least", F.col("doc_id").eqNullSafe(F.col("component_id"))).write.parquet(path)
    classes = spark.read.parquet(path)
    ids = classes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("least").alias("kept")).where("kept")
    rows = docs.alias("__docs")

    def chosen(ids: DataFrame) -> DataFrame:
        ids = ids.alias("__keep")
        return rows.join(ids, F.col("__docs.doc_id").eqNullSafe(F.col("__keep.doc_id")), "left_semi")

    def with_bits(batches):
        for block in blocks(batches):
            made = np.array([fingerprint(x, shingle) for x in block.texts()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*block.rows.columns, pa.array(made)], [*block.rows.schema.names, "__bits"])

    # where rows share an id, or have none, the fingerprint says of which component a row is; texts are compared only there
    shared = chosen(ids.where("n > 1")).mapInArrow(with_bits, StructType([*docs.schema.fields, StructField("__bits", LongType())]))
    least = classes.where("least").select("doc_id", "bits").distinct().alias("__least")
    same = F.col("__shared.doc_id").eqNullSafe(F.col("__least.doc_id")) & (F.col("__bits") == F.col("__least.bits"))
    shared = shared.alias("__shared").join(least, same, "left_semi").drop("__bits")
    return chosen(ids.where("n = 1")).union(shared.dropDuplicates(["doc_id", "text"]))
