"""The alignment of two tokenizers against brute force, and on odd input."""

import hashlib
from collections import Counter, defaultdict

import pandas as pd
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakeops.llm import alignment, packing, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(alignment.path(alignment.VOCABULARY_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.path(alignment.VOCABULARY_B))


def slow(rows, a, b):
    """The contract's columns, token by token."""
    letters = {}
    for byte in range(256):
        letters[chr(byte) if chr(byte).isprintable() and byte not in (0x20, 0xA0, 0xAD) else chr(0x100 + len([x for x in letters if ord(x) >= 0x100]))] = byte
    links, counts, out = {}, Counter(), []
    for i, (_, text) in enumerate(rows):
        links[i], whole = [], b" " + (text or "").encode()
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        bytes_a = [bytes(letters[c] for c in a.id_to_token(x)) for x in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b, groups = defaultdict(list), defaultdict(list), [[[], []]]
        for ids, spelled, ends in ((ids_a, bytes_a, ends_a), (ids_b, bytes_b, ends_b)):
            at = 0
            for x, s in zip(ids, spelled, strict=True):
                at += len(s)
                ends[at].append(x)
        for at in sorted(ends_a.keys() | ends_b.keys()):
            groups[-1][0] += ends_a[at]
            groups[-1][1] += ends_b[at]
            if ends_a[at] and ends_b[at]:
                links[i] += [(x, y) for x in ends_a[at] for y in ends_b[at]]
                groups.append([[], []])
        groups.pop()
        text_of = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        counts.update(links[i])
        out.append([len(ids_a), len(ids_b), len(groups), len(links[i]), hashlib.sha256(text_of.encode()).hexdigest() if ids_a else ""])
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return Counter((d, *o[:4], sum(counts[x] == most[x[1]] for x in links[i]), sum(counts[x] for x in links[i]), o[4]) for i, ((d, _), o) in enumerate(zip(rows, out, strict=True)))


def got(frame):
    return Counter(tuple(r) for r in frame.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def test_query_equals_brute_force(spark, tokenizers):
    t = pd.read_parquet(f"{SF}/documents.parquet")
    want = slow(list(zip(t.doc_id.tolist(), t.text.tolist(), strict=True)), *tokenizers)
    assert got(queries.QUERIES["op11_tokenizer_alignment"](spark, SF)) == want


@pytest.mark.parametrize("portion", [1 << 22, 100])
def test_odd_input(spark, tokenizers, monkeypatch, portion):
    monkeypatch.setattr(alignment, "PORTION", portion)
    texts = [None, "", " ", "  two  spaces ", "<|endoftext|> <s> </s> <unk> <0x41> ▁", "tab\tand\nline\r\n", "é é ☃😀 ﬁ Ⅳ", "\x00\x01", "a" * 3000, " " * 50_000,
             "same text here", "same text here", "日本語のテキスト", "word " * 30_000]
    rows = [*enumerate(texts), (None, "same text here"), (3, "another row with the id")]
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, portion string, links string")
    want = slow(rows, *tokenizers)
    assert got(alignment.token_alignment(frame)[0]) == want
    assert sum(w[1] == 0 for w in want) < 6
    assert got(alignment.token_alignment(frame.limit(0))[0]) == Counter()


def test_invalid_text_has_no_tokens(spark):
    frame = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert got(alignment.token_alignment(frame)[0]) == Counter([(1, 0, 0, 0, 0, 0, 0, "")])


def test_pairs_of_the_corpus(spark):
    frame = spark.createDataFrame([(i, "the river and the road") for i in range(7)], "doc_id int, text string").repartition(3)
    scored, pairs = alignment.token_alignment(frame)
    links = scored.agg({"n_links": "sum"}).first()[0]
    assert pairs.agg({"count": "sum"}).first()[0] == links and all(r["count"] % 7 == 0 and r.best for r in pairs.collect())


def test_ids_by_ranks(monkeypatch):
    """The library by ranks is the one that encodes, with the other's ids;
    runs that are too long for it go to the other."""
    file, ranks = alignment.path(alignment.VOCABULARY_A), alignment.path(packing.VOCABULARY)
    texts = [" ", " <|endoftext|> <s>", " it's I'LL 'S 1234567 ½", " é é ☃😀 ﬁ Ⅳ \u00a0\u3000\u2028\u0085x", "  two  spaces \t\n\r\n ", " 日本語のテキスト", " \x00\x01",
             " " * 3000 + "x", " " + "ab" * 1500, *(" " + t for t in pd.read_parquet(f"{SF}/documents.parquet").text.fillna("")[:300])]
    (slow_ids, table), (quick_ids, same) = alignment.encoder_a(file), alignment.encoder_a(file, ranks)
    assert quick_ids(texts) == slow_ids(texts) and table == same
    asked = []
    monkeypatch.setattr(alignment, "encoder_a", lambda *files: asked.append(files) or (quick_ids, table))
    alignment.align(["a text"], file, alignment.path(alignment.VOCABULARY_B))
    assert asked == [(file, ranks)]
