"""Alignment of two tokenizers against a plain version that looks at every pair of tokens."""

import hashlib

import numpy as np
import odd
import pytest

from fareflow.llm import alignment as al

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog."), (2, "The quick brown fox, naïve café 漢字 😀!"), (3, None), (4, ""), (5, " "),
    (6, "  two  spaces \n\n and lines\t"), (7, "<|endoftext|> <s> </s> <0x41> <unk>"), (8, "has ▁ a mark"), (9, "The quick brown fox"),
    (9, "The quick brown fox"), (None, "over the lazy dog"), (11, "supercalifragilistic antidisestablishment"), (12, "\x00\x01 control"),
    (13, "a" * 5000), (14, "ﬁne ² ½ Ａ wide"),
]


@pytest.fixture(scope="module")
def coders():
    return al.coder(al.byte_level_coder, al.read_file(al.BYTE_LEVEL)), al.coder(al.piece_coder, al.read_file(al.PIECES))


def plain_text(text, a, b):
    """ids, links (i, j, bytes) and groups of one text."""
    if not text:
        return [], [], [], []
    (x,), (y,) = a.encode([text]), b.encode([text])
    whole = b" " + text.encode()
    if b"".join(a.spelled[i] for i in x) != whole or b"".join(b.spelled[i] for i in y) != whole:
        return [], [], [], []

    def spans(ids, spelled):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(spelled[i])))
            at += len(spelled[i])
        return out

    p, q = spans(x, a.spelled), spans(y, b.spelled)
    links = [(i, j, min(e, f) - max(s, t)) for i, (s, e) in enumerate(p) for j, (t, f) in enumerate(q) if s < f and t < e]
    groups, begin = [], 0
    for end in sorted({e for _, e in p} & {e for _, e in q}):
        groups.append(([i for i, (s, _) in enumerate(p) if begin <= s < end], [j for j, (s, _) in enumerate(q) if begin <= s < end]))
        begin = end
    return x, y, links, groups


def plain(rows, a, b):
    found = [(i, *plain_text(t, a, b)) for i, t in rows]
    docs, best = {}, {}
    for _, x, y, links, _ in found:
        for pair in {(x[i], y[j]) for i, j, _ in links}:
            docs[pair] = docs.get(pair, 0) + 1
    for (i, _), n in docs.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for doc_id, x, y, links, groups in found:
        pairs = [(x[i], y[j]) for i, j, _ in links]
        text = ";".join(",".join(str(x[i]) for i in g) + "|" + ",".join(str(y[j]) for j in h) for g, h in groups)
        out.append((
            doc_id, len(x), len(y), len(groups), len(links), sum(len(g) * len(h) for g, h in groups),
            hashlib.sha256(text.encode()).hexdigest() if text else "", sum(docs[p] == best[p[0]] for p in pairs), sum(docs[p] for p in pairs),
        ))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups_sha256", "n_best", "count_sum"]


@pytest.mark.parametrize("common", [0, 40, 1 << 20])
def test_against_every_pair_of_tokens(spark, coders, common):
    got = al.aligned_documents(odd.documents(spark, TEXTS), common=common).select(*COLUMNS).collect()
    want = plain(TEXTS, *coders)
    assert sorted(map(tuple, got), key=str) == want
    assert sum(w[1] > 0 for w in want) > 8


def test_links_and_groups_themselves(spark, coders):
    got = {r.doc_id: r for r in al.token_links(odd.documents(spark, TEXTS)).collect()}
    for doc_id, text in TEXTS:
        x, y, links, groups = plain_text(text, *coders)
        r = got[doc_id]
        assert (list(r.ids_a), list(r.ids_b)) == (x, y)
        assert sorted(zip(r.link_a, r.link_b, r.shared_bytes)) == sorted(links)
        assert [[i for i, g in enumerate(r.group_a) if g == k] for k in range(len(groups))] == [g for g, _ in groups]
        assert [[j for j, g in enumerate(r.group_b) if g == k] for k in range(len(groups))] == [h for _, h in groups]


def test_group_products(coders):
    texts = [t for _, t in TEXTS]
    found = al.align(texts, *coders)
    want = {(i, j) for i, g in enumerate(found.group_a) for j, h in enumerate(found.group_b) if g == h} if len(found.ids_a) < 10_000 else None
    for block in (1, 7, 1 << 20):
        parts = list(found.group_links(block))
        got = [(int(i), int(j)) for row, column, _ in parts for i, j in zip(row, column)]
        assert len(got) == len(set(got)) == found.n_group_links().sum()
        assert want is None or set(got) == want


def test_products_of_any_sparse_matrices():
    rng = np.random.default_rng(4)
    x, y = rng.random((9, 12)) < 0.3, rng.random((12, 7)) < 0.3

    def rows(m):
        return al.Rows(np.r_[0, np.cumsum(m.sum(axis=1))], np.nonzero(m)[1], m.shape[1])

    row, column, value = al.product(rows(x), rows(y))
    dense = np.zeros((9, 7), dtype=np.int64)
    dense[row, column] = value
    assert (dense == x.astype(int) @ y.astype(int)).all() and (value > 0).all()
    back = rows(x).transposed()
    assert (back.index == np.nonzero(x.T)[1]).all() and (back.start == rows(x.T).start).all()


def test_odd_documents(spark, coders):
    got = al.aligned_documents(odd.odd_documents(spark)).select(*COLUMNS).collect()
    short = {r[0]: r[1] for r in odd.ODD if r[0] not in (5, 9, 10)}
    assert len(got) == len(odd.ODD)
    for r in got:
        if r.doc_id in short:
            x, y, links, groups = plain_text(short[r.doc_id], *coders)
            assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(x), len(y), len(groups), len(links))
    assert all(r.n_a > 1000 for r in got if r.doc_id in (5, 9, 10))
    assert al.aligned_documents(odd.no_documents(spark)).count() == 0


def test_words_are_encoded_once_and_as_in_their_text(coders):
    odd_parts = ["two  spaces", "a\nb", "\n x", "x \n", "it's", "'s", "«", "é", "é » a", "漢字", "。", "᠎", "x᠎", "\xa0", "a\xa0", "▁", "b ▁ c", "1 2", "<s>", "\x00", ""]
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(odd_parts, rng.integers(1, 12))) for _ in range(600)]
    for made in (al.byte_level_coder(al.read_file(al.BYTE_LEVEL)), al.piece_coder(al.read_file(al.PIECES))):
        asked, encode = [], made.encode
        made.encode = lambda lines: asked.extend(lines) or encode(lines)
        assert made.cuts
        for part in (texts, texts):
            ids, text, good = made.tokens([al.CUT.split(t) for t in part])
            for k, (t, whole) in enumerate(zip(part, encode(part))):
                assert good[k] == (made.spell(whole) == b" " + t.encode())
                assert not good[k] or ids[text == k].tolist() == list(whole)
        assert sum(map(len, asked)) < sum(map(len, texts))
