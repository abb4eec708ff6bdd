import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from barloom.llm.token_scan import count_tokens, write_token_files

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute(ids, separator=2):
    out, n, start = [], 0, 0
    for i, x in enumerate(ids):
        if x == separator:
            out.append((start, i - start))
            start = i + 1
    return out + ([(start, len(ids) - start)] if start < len(ids) else [])


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_scan_equals_brute_force(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    files = {"a": rng.integers(1, 9, 500), "b": np.array([], int), "c": np.full(40, 5), "d": np.array([2, 2, 2]), "e": np.r_[np.full(30, 7), 2]}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(ids.astype("<u2").tobytes())
    got = {}
    for r in count_tokens(spark, str(tmp_path), block=block).collect():
        got.setdefault(r.file[-1], []).append((r.document, r.start, r.n_tokens))
    for name, ids in files.items():
        assert sorted(got.get(name, [])) == [(i, *x) for i, x in enumerate(brute(ids.tolist()))]


def test_torn_files_raise(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"\x01\x00\x02")
    with pytest.raises(Exception, match="no whole number of ids"):
        count_tokens(spark, str(tmp_path)).collect()


def test_written_files_count_each_document(spark, tmp_path):
    texts = [None, "", "one", "two words </s> here", "x " * 20_000, "one"]
    docs = spark.createDataFrame([(t, 1) for t in texts], "text string, file int").repartition(2)
    write_token_files(docs, str(tmp_path / "t"), MODEL)
    sp = SentencePieceProcessor(model_file=MODEL)
    wanted = sorted(sum(len(sp.encode(w)) for w in (t or "").split()) for t in texts)
    (tmp_path / "t" / "_SUCCESS").unlink(missing_ok=True)
    assert sorted(r.n_tokens for r in count_tokens(spark, str(tmp_path / "t")).collect()) == wanted
    write_token_files(docs.limit(0), str(tmp_path / "e"), MODEL)
    assert count_tokens(spark, str(tmp_path / "e")).count() == 0
