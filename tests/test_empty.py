"""Every registered query over tables without rows, and over tables with nulls in any column and repeated rows."""

from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

DATA = Path("/root/testdata/sf0.001")
#: Queries whose one row counts something or lists what was asked for.
COUNTS = {"chunk_bookkeeping", "knn_hits", "corpus_split", "corpus_root"}


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_empty_tables(spark, tmp_path):
    import __spark_entry__ as e

    for f in DATA.glob("*.parquet"):
        pq.write_table(pq.read_table(f).slice(0, 0), tmp_path / f.name)
    for name, query in e.queries().items():
        assert query(spark, str(tmp_path)).count() == (1 if name in COUNTS else 0), name


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_nulls_anywhere_and_repeated_rows(spark, tmp_path):
    import __spark_entry__ as e

    r = np.random.default_rng(1)
    for f in DATA.glob("*.parquet"):
        t = pq.read_table(f).combine_chunks()
        cols = [pa.chunked_array([pa.concat_arrays(c.chunks).take(pa.array([None if x else i for i, x in enumerate(r.random(len(t)) < 0.25)], pa.int64()))]) for c in t.columns]
        t = pa.table(cols, schema=pa.schema([pa.field(x.name, x.type, True) for x in t.schema]))
        pq.write_table(pa.concat_tables([t, t.slice(0, 50)]), tmp_path / f.name)
    for query in e.queries().values():
        query(spark, str(tmp_path)).write.format("noop").mode("overwrite").save()
