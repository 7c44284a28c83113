"""Token alignment against a plain version that walks both sequences byte by byte."""

import hashlib
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from viewloom.llm import align
from viewloom.llm.queries import op12_token_alignment, tokenizer_path
from viewloom.llm.text import table

from .helpers import AWKWARD, docs

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = [
    "it's <|endoftext|> <s> </s> <unk> <0x41> plain",
    "tabs\tand\n\nlines \n  of   many    kinds   ",
    "  leading and no-break space  x  y　z \u0085 w",
    "under▁score is a space to one of them",
    "日本語テキスト with 한국어 and emoji 👩‍👩‍👧 in it, ½ ﬁ é é",
    "a" * 300 + " " + "é" * 200 + " " + "x " * 50,
    "\x00 zero \x1c\x1d",
    "don't DON'T we'll 123 4567, (x)! ...??",
    " ",
    "\n",
]


def plainly(texts):
    a_tok, b_tok = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_tok.encode_special_tokens = True
    byte = align.byte_of()
    names = {i: x for x, i in a_tok.get_vocab().items()}
    found = []
    for t in texts:
        whole = (" " + t).encode() if t else b""
        a = a_tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_tok.encode(t) if t else []
        spelled_a = [bytes(byte[c] for c in names[i]) for i in a]
        pieces = [b_tok.id_to_piece(i) for i in b]
        spelled_b = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
        if b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            a, b, spelled_a, spelled_b = [], [], [], []
        of_a = [k for k, x in enumerate(spelled_a) for _ in x]
        of_b = [k for k, x in enumerate(spelled_b) for _ in x]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(of_a, of_b, strict=True)))]
        groups, i, j = [], 0, 0
        for at in range(len(of_a)):
            last = at + 1 == len(of_a)
            if last or (of_a[at] != of_a[at + 1] and of_b[at] != of_b[at + 1]):
                x, y = of_a[at] + 1, of_b[at] + 1
                groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
                i, j = x, y
        found.append((len(a), len(b), groups, links))
    counts = Counter(p for _, _, _, links in found for p in set(links))
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for n_a, n_b, groups, links in found:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links), sha))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_is_exact(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in op12_token_alignment(spark, sf_dir).collect()}
    assert got == dict(zip([r["doc_id"] for r in texts], plainly([r["text"] for r in texts]), strict=True))


@pytest.mark.parametrize("most_pairs", [1, 40, 100_000])
def test_odd_texts(spark, most_pairs):
    rows = [*AWKWARD, *[(100 + k, t, "s") for k, t in enumerate(ODD)], (300, "word " * 60_000 + "end", "s"), (301, "nospace" * 40_000, "s")]
    df = docs(spark, rows).withColumns({c: F.lit("clash") for c in ("_row", "pairs", "times", "groups", "n_a", "pair", "count")})
    got = align.counted(df, *PATHS, ["doc_id"], most_pairs=most_pairs)
    assert sorted(map(str, (tuple(r[c] for c in ["doc_id", *COLUMNS]) for r in got.collect()))) == sorted(
        str((r[0], *x)) for r, x in zip(rows, plainly([r[1] for r in rows]), strict=True)
    )


def test_empty_table(spark):
    assert align.counted(docs(spark, []), *PATHS, ["doc_id"]).collect() == []


def test_groups_are_written(spark):
    r = align.aligned(docs(spark, [(1, "unbelievable things", "s")]), *PATHS, ["doc_id"]).first()
    assert hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] and len(r["groups"].split(";")) == r["n_groups"]
    assert sum(r["times"]) == r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]


def test_thinned_out_tables_give_the_same(monkeypatch):
    texts = pa.array([f"words {i} and {i % 7} others like {i * i} of them" for i in range(300)])
    whole = align.Aligner(*PATHS)(texts, True)
    monkeypatch.setattr(align, "MOST_WORDS", 20)
    small = align.Aligner(*PATHS)
    small.words.known.most = 20
    for _ in range(2):
        for k in range(0, 300, 50):
            out = small(texts.slice(k, 50), True)
            assert all(x.to_pylist() == y.slice(k, 50).to_pylist() for x, y in zip(out, whole, strict=True))
    assert len(small.known.values) < 400


def test_words_equal_whole_texts():
    aligner = align.Aligner(*PATHS)
    texts = [t for t in [*ODD, *[t for _, t, _ in AWKWARD if t]] if t]
    _, (a, at_a), (b, at_b) = aligner.ids(pa.array(texts))
    for k, t in enumerate(texts):
        if at_a[k] < at_a[k + 1]:
            assert a[at_a[k] : at_a[k + 1]].tolist() == aligner.encoders.ids_a([" " + t])[1].tolist()
            assert b[at_b[k] : at_b[k + 1]].tolist() == aligner.encoders.ids_b([" " + t])[1].tolist()
