"""Many small records as few binary rows, so that shuffles and sorts run on arrays.

A row holds a bucket number and the columns of its records one after another.
Buckets are cut by a hash, so a bucket's size follows the number of buckets.
"""

import numpy as np
import pyarrow as pa

# Records that one partition should hold: some tens of MB with all working copies.
PARTITION_RECORDS = 1_000_000
BUCKETS_PER_PARTITION = 4


def partitions_for(spark, records):
    """Partitions so that each holds about PARTITION_RECORDS, and no fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(records) // PARTITION_RECORDS))


def bucket_of(hashes, buckets):
    """Bucket by the upper bits of a 64-bit hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def pack(columns):
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def unpack(blobs, dtypes):
    """Columns of all blobs, concatenated."""
    width = sum(np.dtype(d).itemsize for d in dtypes)
    parts = [[] for _ in dtypes]
    for blob in blobs:
        raw = memoryview(blob)
        n, at = len(raw) // width, 0
        for k, d in enumerate(dtypes):
            size = n * np.dtype(d).itemsize
            parts[k].append(np.frombuffer(raw[at : at + size], d))
            at += size
    return [np.concatenate(p) if p else np.empty(0, d) for p, d in zip(parts, dtypes, strict=True)]


def rows_by_bucket(bucket, columns, names=("bucket", "data"), kind=np.int32):
    """One record batch: a row per bucket with its records packed."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    columns = [c[order] for c in columns]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, int)
    last = np.append(first[1:], len(bucket)).astype(int)
    data = [pack([c[a:b] for c in columns]) for a, b in zip(first, last, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(kind)), pa.array(data, pa.binary())], names=list(names))


def runs(sorted_keys):
    """(first, end) of the runs of equal keys."""
    if not len(sorted_keys):
        return np.empty(0, int), np.empty(0, int)
    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return first, np.append(first[1:], len(sorted_keys))


def all_blobs(batches, column):
    """Every blob of the given column of a partition."""
    for batch in batches:
        for value in batch.column(batch.schema.get_field_index(column)):
            yield value.as_buffer()
