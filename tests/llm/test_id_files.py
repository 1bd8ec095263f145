"""Round trips of the Arrow sequence files against direct tokenisation."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterlake.llm import id_files
from meterlake.llm import queries as Q
from meterlake.llm.encode import default_tokenizer
from meterlake.session import scratch_path

from .conftest import ODD_ROWS

SF = "/root/testdata/sf0.001"


def brute(rows):
    """[(doc_id, start, n, crc, ids)] in file order, rows = (doc_id, text)."""
    from tokenizers import Tokenizer

    t, at, out = Tokenizer.from_file(default_tokenizer()), 0, []
    for doc_id, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_query_matches_direct_tokenisation(spark):
    docs = [(r.doc_id, r.text) for r in Q.read(spark, SF, "documents").select("doc_id", "text").collect()]
    got = Q.QUERIES["op11_token_ids"](spark, SF).collect()
    assert sorted(map(tuple, got)) == [r[:4] for r in brute(by_id(docs))]


@pytest.mark.parametrize("size,batch,limit", [(16, 4, 32), (2048, 64, 1 << 17), (7, 3, 1)])
def test_odd_rows_and_short_files(spark, odd, size, batch, limit):
    """Sequences shorter than documents, files shorter than a document."""
    files = id_files.written(odd, scratch_path(spark, "t"), size=size, batch=batch, file_sequences=limit)
    got = sorted(id_files.read_back(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r[0] for r in by_id(ODD_ROWS)]
    texts = {}
    for r in brute([(r[0], r[1]) for r in ODD_ROWS]):
        texts.setdefault(r[0], []).append((r[2], r[3], r[4]))
    at = 0
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32, r.ids) in texts[r.doc_id]
        at += r.n_tokens


def test_empty_table(spark, none):
    files = id_files.written(none, scratch_path(spark, "t"))
    assert files.count() == 0 and id_files.read_back(files).count() == 0


def test_random_access_is_a_view(spark, odd):
    """Every sequence by number equals the stream's; local ones share memory
    with the map; masks tell padding and documents' ends."""
    files = id_files.written(odd, scratch_path(spark, "t"), size=64, batch=8).collect()
    for f in files:
        path = f.file.removeprefix("file:")
        with pa.OSFile(path + ".arrows") as source:
            table = pa.ipc.open_stream(source).read_all()
        assert table.schema.field("ids").type == pa.list_(pa.field("item", pa.uint16(), nullable=False), 64)
        got = id_files.SequenceFile(f.file)
        assert len(got) == len(table) and len(got) % 8 == 0
        before = pa.total_allocated_bytes()
        for k in (0, 1, len(got) // 2, len(got) - 1):
            parts = got[k]
            assert [p.to_pylist() for p in parts] == [table[c][k].as_py() for c in ("ids", "mask", "last")]
            assert pa.total_allocated_bytes() - before < 64 * 8  # the map's pages, no buffers of Arrow's own
            view = parts[0].to_numpy(zero_copy_only=True)
            assert not view.flags.owndata and not view.flags.writeable
        mask = [x for k in range(len(got)) for x in got[k][1].to_pylist()]
        assert sum(mask) == f.tokens and all(mask[:f.tokens])
        assert sum(sum(got[k][2].to_pylist()) for k in range(len(got))) == f.documents
        with pytest.raises(IndexError):
            got[len(got)]


def test_lost_attempts_are_not_read(spark, odd):
    """A file that no manifest names, as an attempt that died leaves it."""
    import shutil

    path = scratch_path(spark, "t")
    files = id_files.written(odd, path)
    name = files.first().file.removeprefix("file:")
    for end in (".arrows", ".index.arrows"):
        shutil.copyfile(name + end, name + "-dead" + end)
    assert id_files.read_back(files).count() == len(ODD_ROWS)


def test_one_id_of_very_many_rows_is_no_hot_range(spark):
    docs = spark.range(20_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("one two").alias("text"))
    files = id_files.written(docs, scratch_path(spark, "t")).collect()
    assert sum(f.documents for f in files) == 20_000
    assert len(files) == 1 or max(f.documents for f in files) < 10_000


def test_vocabulary_decides_the_width():
    assert id_files.sequence_schema(8, 49_408).field("ids").type.value_type == pa.uint16()
    assert id_files.sequence_schema(8, 70_000).field("ids").type.value_type == pa.uint32()
