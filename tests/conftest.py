import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Where the test tables are.
DATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from strophe.session import local_session

    return local_session(4, 4, "4g")


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{DATA}/sf0.01"


@pytest.fixture(scope="session")
def odd_tables(spark, small, tmp_path_factory):
    """Folders of tables: empty ones, and ones with nulls in every column, repeated rows, ties, empty and long texts, and columns with clashing names."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    names = [f[:-8] for f in os.listdir(small) if f.endswith(".parquet")]
    empty, odd = tmp_path_factory.mktemp("empty"), tmp_path_factory.mktemp("odd")
    clashing = ("key", "row", "bucket", "block", "source", "who", "said", "units", "h", "part", "code", "g", "r", "t", "__key", "place", "family", "key_", "bucket_", "size", "piece_no", "lang_", "n", "s", "e")
    for name in names:
        table = pq.read_table(f"{small}/{name}.parquet")
        pq.write_table(table.slice(0, 0), empty / f"{name}.parquet")
        head = table.slice(0, min(60, table.num_rows))
        parts = [head, head.slice(0, 5), head.slice(0, 5)]
        for i, field in enumerate(table.schema):
            parts.append(head.slice(i % 7, 3).set_column(i, field, pa.nulls(min(3, head.num_rows - i % 7), field.type)))
        parts.append(pa.table({f.name: pa.nulls(2, f.type) for f in table.schema}, schema=table.schema))
        if "text" in table.schema.names:
            at = table.schema.names.index("text")
            for text in ("", " ", "​", "a" * 50_000, "คำ" * 20_000, "word " * 20_000, "。" * 3_000, "[" * 2_000, "(00:01) " * 500, "“" * 500 + "”" * 500, "S0: " * 200, "😀".encode("utf-16", "surrogatepass").decode("utf-16")):
                one = head.slice(0, 1).set_column(at, table.schema.field(at), pa.array([text], table.schema.field(at).type))
                parts.append(one)
        whole = pa.concat_tables(parts)
        for column in clashing:
            if column not in whole.schema.names:
                whole = whole.append_column(column, pa.array(range(whole.num_rows), pa.int64()))
        pq.write_table(whole, odd / f"{name}.parquet")
    return {"empty": str(empty), "odd": str(odd)}
