import bisect
import hashlib
import itertools
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from viewtally.llm import alignment, queries
from viewtally.llm.alignment import Csr, align_documents, byte_level_tokenizer, gustavson, piece_tokenizer, product_sizes, score_links, token_links

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "word", "two words", "  leading and  double  spaces ", "tabs\tand\r\nlines\n\n", "it's John's 2024 1,000.50", "日本語の文章です 中文", "é ñ ü ß ﬁ ½ Ⅷ",
    "😀 👩‍👩‍👧 flags 🇩🇪", "\x00 nul \x01", "▁ a mark of pieces", "<|endoftext|> </s> <s> <unk> <0x41>", "same text", "same text", "a" * 5000, " " * 3000, "ab " * 4000,
    "Ünïcödé " * 50, "́ combining é", "ᲊ'd Ᲊ late letters",
]


@pytest.fixture(scope="module")
def pair():
    return byte_level_tokenizer(JSON, public_tokenizers.PATTERN), piece_tokenizer(MODEL)


@pytest.fixture(scope="module")
def plain():
    """Texts to ([(id, bytes)], [(id, bytes)]) by the two libraries themselves."""
    first = tokenizers.Tokenizer.from_file(JSON)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters)}

    def piece(i):
        x = second.id_to_piece(i)
        return bytes([int(x[3:5], 16)]) if second.is_byte(i) else x.replace("▁", " ").encode()

    def encode(text):
        if not text:
            return [], []
        whole = (" " + text).encode()
        a = [(i, bytes(alphabet[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, piece(i)) for i in second.encode(text)]
        fits = all(b"".join(t for _, t in x) == whole for x in (a, b))
        return (a, b) if fits else ([], [])

    return encode


def spans(tokens):
    ends = list(itertools.accumulate(len(t) for _, t in tokens))
    return list(zip([0, *ends], ends, strict=False))


def links_of(a, b):
    """Pairs of places that share bytes, by walking both."""
    found, j = [], 0
    at, bt = spans(a), spans(b)
    for i, (low, high) in enumerate(at):
        while j < len(bt) and bt[j][1] <= low:
            j += 1
        k = j
        while k < len(bt) and bt[k][0] < high:
            found.append((i, k))
            k += 1
    return found


def groups_of(a, b):
    at, bt = spans(a), spans(b)
    cuts = sorted({e for _, e in at} & {e for _, e in bt})
    out = [([], []) for _ in cuts]
    for side, own in enumerate((at, bt)):
        for place, (_, end) in enumerate(own):
            out[bisect.bisect_left(cuts, end)][side].append(place)
    return out


def brute(texts, encode):
    both = [encode(t) for t in texts]
    links = [links_of(a, b) for a, b in both]
    pairs = [Counter((a[i][0], b[j][0]) for i, j in own) for (a, b), own in zip(both, links, strict=True)]
    docs = Counter(p for own in pairs for p in own)
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    rows = []
    for i, ((a, b), own, counted) in enumerate(zip(both, links, pairs, strict=True)):
        groups = groups_of(a, b)
        told = ";".join(",".join(str(a[x][0]) for x in g) + "|" + ",".join(str(b[x][0]) for x in h) for g, h in groups)
        best = sum(n for p, n in counted.items() if docs[p] == most[p[0]])
        total = sum(n * docs[p] for p, n in counted.items())
        rows.append((i, len(a), len(b), len(groups), len(own), best, total, hashlib.sha256(told.encode()).hexdigest() if a else "", sum(len(g) * len(h) for g, h in groups)))
    return rows


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("head", [1 << 20, 40, 0])
def test_documents_match_a_walk_over_both_token_lists(spark, make_docs, pair, plain, head):
    docs = make_docs(list(enumerate(TEXTS)))
    assert found(score_links(align_documents(docs, *pair, keep=["doc_id"]), head_pairs=head)) == brute(TEXTS, plain)


def test_links_row_by_row(spark, make_docs, pair, plain, monkeypatch):
    monkeypatch.setattr(alignment, "PRODUCT_ENTRIES", 3)
    texts = TEXTS[:17]
    for kind in ("overlap", "group"):
        got = sorted(tuple(r) for r in token_links(make_docs(list(enumerate(texts))), *pair, kind=kind, keep=["doc_id"]).collect())
        want = []
        for n, t in enumerate(texts):
            a, b = plain(t)
            places = links_of(a, b) if kind == "overlap" else [(i, j) for g, h in groups_of(a, b) for i in g for j in h]
            want += [(n, i, j, a[i][0], b[j][0]) for i, j in places]
        assert got == sorted(want)


def test_byte_level_ids_are_those_of_the_library(pair):
    first = tokenizers.Tokenizer.from_file(JSON)
    first.encode_special_tokens = True
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}'d {chr(c)} !{chr(c)}\n" for c in points[k : k + 200]) for k in range(0, len(points), 200)]
    ids, at = pair[0].make()(texts)
    want = [e.ids for e in first.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(at.tolist())] == want


def test_products_are_those_of_dense_matrices():
    rng = np.random.default_rng(3)
    for n, m, k in [(5, 7, 4), (1, 1, 1), (6, 3, 9)]:
        left, right = (rng.random(s) < 0.4 for s in ((n, m), (m, k)))
        a, b = (Csr(np.concatenate([[0], np.cumsum(x.sum(axis=1))]), np.nonzero(x)[1], x.shape[1]) for x in (left, right))
        got = gustavson(a, b)
        dense = np.zeros((n, k), int)
        dense[got.entry_rows(), got.columns] = got.values
        assert (dense == left.astype(int) @ right.astype(int)).all() and (got.values > 0).all()
        assert (product_sizes(a, b) == (left.astype(int) @ right.sum(axis=1))).all()


def test_empty_table_odd_rows_and_clashing_columns(spark, make_docs, odd, pair, plain):
    assert score_links(align_documents(make_docs([]), *pair)).count() == 0
    clash = odd.withColumns({"row": F.lit("r"), "times": F.lit(1), "a.b": F.lit(2), "c0": F.lit(3)})
    got = score_links(align_documents(clash, *pair, keep=["doc_id", "text", "row", "a.b", "c0"]))
    assert got.columns[:5] == ["doc_id", "text", "row", "a.b", "c0"]
    rows = got.collect()
    texts = [r["text"] for r in rows]
    assert [tuple(r[c] for c in COLUMNS[1:]) for r in rows] == [r[1:] for r in brute(texts, plain)]
    assert {(r["row"], r["a.b"], r["c0"]) for r in rows} == {("r", 2, 3)}


def test_query(spark, sf_dir, plain):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = queries.op12_token_alignment(spark, sf_dir)
    assert got.columns == COLUMNS
    want = brute([r.text for r in rows], plain)
    assert found(got) == sorted((r.doc_id, *w[1:]) for r, w in zip(rows, want, strict=True))
