import re
from collections import defaultdict

from conftest import DATA

from corpus_pipeline import STAGES
from barloom.llm.store import Store


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def survivors(rows):
    """The smallest id of each group of near duplicates, every pair compared."""
    sets = {r.doc_id: shingles(r.text) for r in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i for i in ids if root(i) == i}


def test_each_stage_on_what_the_one_before_kept(spark):
    store = Store(spark, "test_pipeline")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in STAGES:
        before = docs.collect()
        docs = store.put(name, stage(spark, docs, DATA))
        kept[name] = docs.collect()
        ids, had = {r.doc_id for r in kept[name]}, {r.doc_id for r in before}
        if name != "packing":
            assert docs.columns == columns
        if name == "quality":
            assert ids < had and set(kept[name]) <= set(before)
        elif name == "near_duplicates":
            assert ids == survivors(before)
        else:
            assert ids == had
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in kept["packing"]:
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 4096
    copies = defaultdict(int)
    for r in kept["mixing"]:
        copies[r.doc_id] += 1
    for doc, rows in pieces.items():
        assert sum(length for _, length, _ in rows) == copies[doc] * rows[0][2]
