import random
import re

import pyarrow as pa
import pytest

from barloom.llm.line_dedup import Lines, line_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """Texts by id, from the definition alone: one pass over all chunks in order of id and position."""
    seen, gone = set(), set()
    for d, text in sorted(rows):
        filled = [(i, line, len(WORD.findall(line)) >= 20) for i, line in enumerate(text.split("\n")) if WORD.search(line)]
        for k, (i, line, long) in enumerate(filled):
            chunks = [((i,), line)] if long else []
            if k + 1 < len(filled) and not (long and filled[k + 1][2]):
                chunks.append(((i, filled[k + 1][0]), line + "\n" + filled[k + 1][1]))
            for places, body in chunks:
                if body in seen:
                    gone |= {(d, p) for p in places}
                seen.add(body)
    out = {}
    for d, text in rows:
        kept, drops = [], False
        for i, line in enumerate(text.split("\n")):
            drops = (d, i) in gone if WORD.search(line) else drops
            if not drops:
                kept.append(line)
        out[d] = "\n".join(kept)
    return out


def test_equals_brute_force(spark):
    rng = random.Random(3)
    lines = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.choice([0, 2, 5, 9, 25, 60]))) for _ in range(60)]
    passage = lines[:7]
    rows = []
    for d in range(80):
        own = [f"own {d} {i}" + " z" * rng.randint(0, 30) for i in range(rng.randint(1, 8))]
        at = rng.randrange(len(own) + 1)
        rows.append((d, "\n".join(own[:at] + (passage if rng.random() < 0.5 else []) + own[at:] + rng.sample(lines, 3))))
    rows += [(100, "a\na\na\n\n \na"), (101, "\n\nb\n"), (102, "é x\r\n\nü y\r\n"), (103, "é x\r\nü y\r"), (104, "\x0b\né x\r\n\n\nü y\r\n\nz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.text for r in line_dedup(docs).collect()}
    assert got == brute(rows)
    assert sum(len(t) for t in got.values()) < sum(len(t) for _, t in rows)


@pytest.mark.parametrize("size", [3, 5, 8, 15])
def test_passages_of_short_lines_go_whole(spark, size):
    """Later copies lose every line, wherever they stand; the lines around them stay."""
    rng = random.Random(size)

    def line(words):
        return " ".join(str(rng.randrange(10**6)) for _ in range(words))

    rows, expected = [], {}
    for p in range(30):
        passage = [line(12) for _ in range(size)]
        for copy in range(3):
            own = [line(rng.randint(1, 18)) for _ in range(rng.randint(0, 9))]
            at = rng.randint(0, len(own))
            rows.append((3 * p + copy, "\n".join(own[:at] + passage + own[at:])))
            expected[3 * p + copy] = rows[-1][1] if copy == 0 else "\n".join(own)
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.text for r in line_dedup(docs).collect()} == expected


def test_lines_cover_the_text():
    texts = ["", "\n", "a\nb\n\nc", "x " * 30 + "\n" + "y " * 40, "é\n" * 9, None, " \n\t"]
    c = Lines(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert c.without(i, []).decode() == (t or "")
    assert c.without(2, [1]) == b"c"
    assert c.without(3, [0, 2]) == b""
    assert Lines(pa.array([], pa.string())).texts == 0


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(2, f"head\n{long}\ntail", 1), (1, long, 1), (2, f"head\n{long}\ntail", 1), (None, long, 0), (5, None, 0), (6, "", 0), (7, "short", 0), (8, "short", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pos int")
    out = line_dedup(docs)
    assert out.schema == docs.schema
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(2, "head\ntail"), (1, long), (2, "head\ntail"), (None, ""), (5, None), (6, ""), (7, "short"), (8, "short")], key=str)
    assert line_dedup(docs.limit(0)).count() == 0


def test_columns_with_clashing_names_pass(spark):
    names = ["_id", "_row", "_at", "_all", "id", "row", "pos", "later", "all", "h1", "c0", "c1", "bytes", "copies", "kept"]
    rows = [(d, "same line\nsecond line\n" + str(d), *(f"{n} {d}" for n in names)) for d in range(4)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    out = line_dedup(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert r.text == ("same line\nsecond line\n0" if r.doc_id == 0 else str(r.doc_id))
        assert [r[n] for n in names] == [f"{n} {r.doc_id}" for n in names]
