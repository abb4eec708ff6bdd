from collections import defaultdict

import numpy as np
import public_tokenizers
from conftest import DATA
from tokenizers import Tokenizer

from barloom.llm.packing import K1, B, Index, pack
from barloom.llm.tokens import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(docs, pieces):
    """An exact round trip: pieces give back the ids of every row."""
    tokenizer = Tokenizer.from_file(PATH)
    wanted = sorted(([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect()))
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces.collect():
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append((p.start, ids, p.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0
    got = []
    for parts in by_doc.values():
        # Rows of one id are told apart by their starts: each start occurs once a row.
        rows: dict = {}
        for start, ids, total in sorted(parts, key=lambda p: p[0]):
            if start == 0:
                rows.setdefault(total, []).append(list(ids))
            else:
                next(r for r in rows[total] if len(r) == start).extend(ids)
        got += [r for group in rows.values() for r in group]
    assert sorted(got) == wanted


def test_round_trip_of_the_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    check(docs, pack(docs, PATH))


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "É<|endoftext|>x it's   é 12", 5), (4, "word " * 30_000, 5), (None, "a b", 5), (6, "same", 5), (7, "same", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    check(docs, pack(docs, PATH))
    assert pack(docs.limit(0), PATH).count() == 0


def test_lexical_neighbours_share_a_window(spark):
    topics = ["alpha beta gamma delta", "red green blue yellow", "north south east west"]
    rows = [(i, " ".join([topics[i % 3]] * 100)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    changes, last = 0, None
    for p in pack(docs, PATH).orderBy("sequence_id", "offset").collect():
        changes += last is not None and last != p.doc_id % 3
        last = p.doc_id % 3
    assert changes <= 2


def test_neighbours_equal_plain_bm25():
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 30, n).tolist() for n in (0, 1, 5, 40, 40, 12, 80, 3)]
    index = Index(np.array([w for t in texts for w in t]), np.r_[0, np.cumsum([len(t) for t in texts])])
    mean = np.mean([len(t) for t in texts])

    def weight(w, t):
        n = sum(w in u for u in texts)
        return np.log1p((len(texts) - n + 0.5) / (n + 0.5)) * t.count(w) * (K1 + 1) / (t.count(w) + K1 * (1 - B + B * len(t) / mean))

    for doc, words in enumerate(texts):
        used = np.arange(len(texts)) == doc
        score = {i: sum(weight(w, t) for w in set(words) if w in t) for i, t in enumerate(texts) if i != doc}
        wanted = sorted((i for i in score if score[i] > 0), key=lambda i: (-round(score[i], 9), i))
        assert index.neighbours(doc, used).tolist() == wanted


def test_words_encoded_together_have_their_own_ids():
    words = ["a", "|", "x|y", "||", "", "<|endoftext|>", "caf\u00e9", "\u0301e", "\u00a0", "it's", "12,5", "<", "\u03a3\u03a3", "#|"] + [f"w{i}" for i in range(900)]
    tokenizer = Tokenizer.from_file(PATH)
    for some in (words, [w for w in words if "|" not in w], ["|", "a|"], [], ["a"]):
        ids, length = word_bpe(PATH)(some)
        ends = np.cumsum(length)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, length)] == [tokenizer.encode(w, add_special_tokens=False).ids for w in some]
