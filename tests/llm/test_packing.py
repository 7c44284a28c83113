import zlib

import numpy as np
from tokenizers import Tokenizer

from viewloom.llm import packing
from viewloom.llm.queries import op9_packing, tokenizer_path
from viewloom.llm.text import table

from .helpers import AWKWARD, docs

ODD = ["it's á ́b <|endoftext|> x<|startoftext|>y \x00 a\x00b İstanbul ß ﬁ 한글 日本語。 ①² Ⅷ don't 12.5€    z \x1c\x85", "É É ǅ ʰ ª º", "a|b, c. d!! e?"]


def check(pieces, texts, window=2048):
    tok = Tokenizer.from_file(tokenizer_path())
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    got, sequences = {}, {}
    for p in pieces:
        a = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        crc = zlib.crc32(bytes(p["ids"])) if "ids" in p else p["ids_crc32"]
        assert crc == zlib.crc32(a.tobytes()) and p["doc_tokens"] == len(ids[p["doc_id"]])
        got.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for i, own in ids.items():
        at = 0
        for start, length in sorted(got[i]):
            assert start == at and length > 0
            at += length
        assert at == len(own)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window and (at == window or at & (at - 1) == 0)


def test_query_is_exact(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    check([r.asDict() for r in op9_packing(spark, sf_dir).collect()], texts)


def test_words_equal_whole_texts():
    words, tok = packing.WordIds(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    for got, t in zip(words([t.encode() for t in ODD]), ODD, strict=True):
        assert got.tolist() == tok.encode(t, add_special_tokens=False).ids


def test_awkward_rows(spark):
    rows = [r for r in AWKWARD if r[0] is not None and r[0] != 6]
    pieces = packing.pack(docs(spark, rows).repartition(2), tokenizer_path(), 64).collect()
    check([r.asDict() for r in pieces], {i: t for i, t, _ in rows}, 64)
    assert packing.pack(docs(spark, AWKWARD), tokenizer_path()).where("doc_id = 6 and start = 0").count() == 2
    assert packing.pack(docs(spark, []), tokenizer_path()).count() == 0


def test_sum_of_squares_choice():
    rng = np.random.default_rng(0)
    levels, w = packing.Levels(32), 32
    for size in rng.integers(1, 32, 300).tolist():
        best = None
        for h in range(w - size, -1, -1):  # brute force over all levels
            if h and not levels.count[h]:
                continue
            n = levels.count.copy()
            if h:
                n[h] -= 1
            if h + size < w:
                n[h + size] += 1
            total = (n[1:w].astype(int) ** 2).sum()
            if best is None or total < best[0]:
                best = (total, h)
        assert levels.place(size) == best[1]
        levels.put(size, (0, 0, None, size))
