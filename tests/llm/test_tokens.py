"""Token files: exact against the tokenizer, exact round trip, selective reads."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from llm_fixtures import docs, table  # noqa: F401

from adtally.config import shared_dir
from adtally.llm import tokens
from adtally.llm.queries import queries

ODD = ["can't WON'T 'S rock'n'roll", "a_b__c 3.14 ½ ² x²", "ÀÖØÝÞß ÷ × ª º µ", "tab\tnl\nvt\x0bff\x0c", "\x00\x1c\x1f z\x7fz",
       "<|endoftext|>", "foo<|endoftext|>.", "x y z", "é İ ẞ Σσς", "日本語 😀 text", "a\x85b", "$$$.", "...", " ", "",
       "The end.\nThe   END!", "don''t 'tis 're"]


def brute(rows):
    tk, out, start = Tokenizer.from_file(tokens.tokenizer_file()), [], 0
    for doc_id, text in rows:
        ids = np.array(tk.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID], np.uint32)
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_equals_the_tokenizer(docs, table, spark):
    rows = [(i * 7 % 101, t) for i, t in enumerate(ODD)] + [(1000, None), (-5, "word " * 4000), (2000, "a" * 3000)]
    got = queries()["op1_token_output"](spark, table(documents=docs(rows)))
    assert sorted(map(tuple, got.collect())) == sorted(brute(sorted(rows)))


def test_whole_given_table(spark):
    d = "/root/testdata/sf0.001"
    got = sorted(map(tuple, queries()["op1_token_output"](spark, d).collect()))
    assert got == brute(sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()))


def test_pieces_equal_whole_texts():
    w, tk = tokens.WordIds(tokens.tokenizer_file()), Tokenizer.from_file(tokens.tokenizer_file())
    for text, ids in zip(ODD, w.encode([t.encode() for t in ODD])):
        assert ids.tolist() == tk.encode(text, add_special_tokens=False).ids + [tokens.END_ID], text


def test_a_full_cache_keeps_what_was_learned_first(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 8)
    w, tk = tokens.WordIds(tokens.tokenizer_file()), Tokenizer.from_file(tokens.tokenizer_file())
    early = "alpha beta gamma delta"
    for text in [early, *ODD, " ".join(f"late{i}" for i in range(9)), early]:
        kept = list(w.pieces)[:4]
        ids, = w.encode([text.encode()])
        assert ids.tolist() == tk.encode(text, add_special_tokens=False).ids + [tokens.END_ID], text
        assert set(kept) <= set(w.pieces)
    assert set(early.split()) <= set(w.pieces) and len(w.pieces) <= 8 + 30


def test_a_task_that_keeps_nothing_holds_little(monkeypatch):
    """Without ``reuse`` a task caches few ids, holds little text at a time and
    leaves nothing in its worker; ids are those of the tokenizer either way."""
    held = []
    make = tokens.WordIds.__init__
    monkeypatch.setattr(tokens.WordIds, "__init__", lambda w, path: (make(w, path), held.append(w))[0])
    monkeypatch.setattr(tokens, "per_worker", lambda key, make: make())
    monkeypatch.setattr(tokens, "TASK_PIECES", 500, raising=False)
    monkeypatch.setattr(tokens, "TASK_BYTES", 4000, raising=False)
    tk = Tokenizer.from_file(tokens.tokenizer_file())
    texts = [" ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}" for j in range(26)) for i in range(200)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(200)), "part": [0] * 200, "text": texts})
    want, sizes = [tk.encode(t, add_special_tokens=False).ids + [tokens.END_ID] for t in texts], {}
    for reuse in (False, True):
        got, sizes[reuse] = [], []
        for rows in tokens.encoder(tokens.tokenizer_file(), [], reuse)(iter([batch])):
            got += rows.column(4).to_pylist()
            sizes[reuse].append(len(held[-1].pieces))
        assert got == want
        assert bool(held[-1].pieces) == reuse
    # a step's pieces come on top of those kept
    assert max(sizes[False]) <= 500 + 26 * 20 < max(sizes[True]) == 26 * 200 and len(sizes[False]) > 5 > len(sizes[True])


def test_repeated_rows_null_ids_and_empty_table(docs, table, spark):
    rows = [(1, "b c"), (1, "b c"), (1, "a"), (None, "x"), (3, "")]
    got = sorted(queries()["op1_token_output"](spark, table(documents=docs(rows))).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 1, 1, 3]
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])])[:-1].tolist()
    assert queries()["op1_token_output"](spark, table(documents=docs([]))).count() == 0


def test_selective_read_and_encodings(docs, spark):
    import glob

    import pyarrow.parquet as pq
    path = shared_dir(spark, "test-tokens")
    df = docs([(i, f"word{i % 50} and more") for i in range(500)]).withColumnRenamed("lang", "part")  # a clashing name
    tokens.write(df, path, tokens.tokenizer_file(), keep=("source",))
    few = tokens.read(spark, path, ["doc_id", "n_tokens"], 100, 109)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,100)" in plan and "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert sorted(r.doc_id for r in few.collect()) == list(range(100, 110))
    group = pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).metadata.row_group(0)
    cols = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "RLE_DICTIONARY" in cols["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in cols["doc_id"].encodings and cols["doc_id"].has_column_index


def test_starts_of_equal_ids_follow_the_files(docs, spark):
    """Walking the files in order, each row starts where the ids before it end."""
    import pyarrow.parquet as pq
    path = shared_dir(spark, "test-token-starts")
    rows = [(i % 3 if i % 4 else None, "w " * (i * 37 % 11)) for i in range(200)] + [(5, "a b c"), (5, "a")]
    tokens.write(docs(rows), path, tokens.tokenizer_file(), parts=6)
    files = {}
    for f in sorted(p for p in __import__("os").listdir(path) if p.endswith(".parquet")):
        for r in pq.read_table(f"{path}/{f}").to_pylist():
            files.setdefault(r["part"], []).append(r)
    walked, start, last = [], 0, float("-inf")
    for part in sorted(files):
        for r in files[part]:
            assert (r["doc_id"] if r["doc_id"] is not None else float("-inf")) >= last
            last = r["doc_id"] if r["doc_id"] is not None else float("-inf")
            walked.append((r["doc_id"], start, r["n_tokens"], zlib.crc32(np.array(r["ids"], np.uint32).tobytes())))
            start += r["n_tokens"]
    key = lambda r: r[1]
    assert len(files) > 3 and walked == sorted((tuple(r) for r in tokens.with_starts(spark, path).collect()), key=key)
    assert sorted((r.doc_id, r.start) for r in tokens.starts(spark, path).where("doc_id = 5").collect()) == sorted(w[:2] for w in walked if w[0] == 5)
    plan = tokens.with_starts(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ids#") and sum("ids" in x.split("ReadSchema")[1] for x in plan.split("FileScan")[1:]) == 1
