"""Connected components of an edge list."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructType

from .skew import checkpointed

#: Edges that a caller may leave to one task (about 100 bytes each while it joins them).
TASK_EDGES = 1_000_000


def joined(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of the component of each of the nodes 0 to ``n - 1``, with edges ``a`` to ``b``.

    In a round every root takes the least root it has an edge to, and what lies inside one tree is dropped.
    """
    label = np.arange(n)
    while len(a):
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        a, b = label[a], label[b]
        a, b = a[a != b], b[a != b]
    return label


def _parts(ids: pa.Array) -> list[np.ndarray]:
    return [f.to_numpy(zero_copy_only=False) for f in (ids.flatten() if pa.types.is_struct(ids.type) else [ids])]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    src, dst = (table.column(c).combine_chunks() for c in ("src", "dst"))
    both = [np.concatenate(p) for p in zip(_parts(src), _parts(dst))]
    code = np.zeros(len(both[0]), np.int64)
    for part in both:  # numbers in the order of the ids, field by field
        values, at = np.unique(part, return_inverse=True)
        code = np.unique(code * len(values) + at, return_inverse=True)[1]
    first = np.zeros(int(code.max()) + 1, np.int64)
    first[code] = np.arange(len(code))
    least = first[joined(code[:len(src)], code[len(src):], len(first))]

    def take(rows):
        fields = [pa.array(p[rows]) for p in both]
        return pa.StructArray.from_arrays(fields, fields=list(src.type)) if pa.types.is_struct(src.type) else fields[0]

    yield pa.RecordBatch.from_arrays([take(first), take(least)], ["id", "component"])


def _of_numbers(kind) -> bool:
    return all(isinstance(f.dataType, LongType) for f in kind.fields) if isinstance(kind, StructType) else isinstance(kind, LongType)


def connected_components(nodes: DataFrame, edges: DataFrame, task_edges: int = 0) -> DataFrame:
    """(id, component): the smallest id of each node's component.

    Labels spread along the edges and then jump to the label of their label, so the
    number of rounds grows with the logarithm of long chains. Every round is written
    out, and stops when no label changed. Up to ``task_edges`` edges between ids that are
    numbers are joined by one task instead; the result is the same.
    """
    kind = nodes.schema["id"].dataType
    if task_edges and _of_numbers(kind):
        edges = checkpointed(edges.select("src", "dst").filter("src <> dst"))
        if edges.count() <= task_edges:
            name = kind.simpleString()
            found = edges.repartition(1).mapInArrow(_solve, f"id {name}, component {name}")
            return checkpointed(nodes.select("id").join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component")))
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = checkpointed(both.filter("src <> dst").distinct())
    labels = checkpointed(nodes.select("id", F.col("id").alias("component")))
    while True:
        spread = both.join(labels, both.src == labels.id).groupBy(F.col("dst").alias("id")).agg(
            F.min("component").alias("_near"))
        stepped = labels.join(spread, "id", "left").select(
            "id", F.col("component").alias("_old"), F.least("component", "_near").alias("component"))
        parents = stepped.select(F.col("id").alias("component"), F.col("component").alias("_up"))
        new = checkpointed(stepped.join(parents, "component", "left").select(
            "id", "_old", F.least("component", "_up").alias("component")))
        changed = new.filter(F.col("component") != F.col("_old")).limit(1).count()
        labels = new.select("id", "component")
        if changed == 0:
            return labels
