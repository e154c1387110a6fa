"""Arrays looked up element by element in a table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Slices of rows for each shuffle partition.
SLICES_PER_TASK = 4


def looked_up(rows: DataFrame, key: str, items: str, names: DataFrame, item: str, value: str, missing: str | None = None) -> DataFrame:
    """``key, found``: for each row the values of its array ``items``, in their order. ``names`` has one row ``item, value`` per item.

    Rows are dealt out in slices by a hash of ``key``. A slice asks for each of its distinct items once, so of a frequent item there are no
    more rows than slices; what is found meets the rows of the slice again. An item without a value is left out, or stops the job with the message
    ``missing``. Rows of one key are taken together by position, and null keys find nothing.
    """
    slices = SLICES_PER_TASK * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(key, items, F.pmod(F.xxhash64(key), F.lit(slices)).alias("_slice")).repartition("_slice")
    # the key is read here too, so that the rows are dealt out once for both uses
    known = dealt.select(F.col("_slice").alias("_asked"), F.explode(F.when(F.col(key).isNotNull(), F.col(items))).alias(item)).distinct()
    how = "left" if missing else "inner"
    named = known.join(names.select(item, value), item, how).select("_asked", item, value)
    kind = names.schema[value].dataType
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField("found", T.ArrayType(kind))])

    def run(held: pa.Table, found: pa.Table) -> pa.Table:
        keys, lists = held[key].combine_chunks(), held[items].combine_chunks()
        if missing and found[value].null_count:
            raise ValueError(f"{missing} {found.filter(pc.is_null(found[value]))[item][0].as_py()}")
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        lengths = np.where(pc.is_valid(keys).to_numpy(zero_copy_only=False), lengths, 0)
        flat = pc.list_flatten(pc.if_else(pc.is_valid(keys), lists, None))
        at = pc.index_in(flat, value_set=found[item].combine_chunks())
        valid = pc.is_valid(at).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(keys)), lengths)[valid]
        pos = (np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[valid]
        values = found[value].combine_chunks().take(at.drop_null())
        coded = keys.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        one, first, rank, count = np.unique(coded, return_index=True, return_inverse=True, return_counts=True)
        if (count[one >= 0] > 1).any():
            # by key, position and value, and the same for each row of the key
            order = np.lexsort((pc.rank(values, tiebreaker="dense").to_numpy(), pos, rank[row]))
            total = np.bincount(rank[row], minlength=len(one))
            starts = (np.cumsum(total) - total)[rank]
            lengths = total[rank]
            within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            values = values.take(pa.array(order[np.repeat(starts, lengths) + within]))
        else:
            lengths = np.bincount(row, minlength=len(keys))
        ends = pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32))
        return pa.table({key: keys, "found": pa.ListArray.from_arrays(ends, values)})

    return dealt.groupBy("_slice").cogroup(named.groupBy("_asked")).applyInArrow(run, schema)
