import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer as Library

from tests.llm.test_packing import ODD
from trawlnet.llm.alignment import Alignment, align
from trawlnet.llm.segments import contents, large, tokens_of
from trawlnet.llm.token_counts import Tokenizer


A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
BLANKS = [
    "a ", " a", "  a  b   c ", "a\n b\n\n  c\t d", "   ", "\n", "a 　b", "a  　 b", "x  y z", "▁a", "a ▁ b", "<0x41> <s> </s> <unk>",
    "tab\t space", "a b c ﬁ ½", "don't 'S 've", "1,234.5 £5 ", "end.\r\n next", "a <|endoftext|> b", " é  à", "\x00 a", "a\x1c b \x85 c", "한 국 어", "אב ג", "x" * 2000,
]
TEXTS = [*ODD, *BLANKS]


def libraries():
    a = Library.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spelled():
    """Bytes of each id, read from the files without the package."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    vocab = json.load(open(A))["model"]["vocab"]
    a = {i: bytes(byte.get(c, 0) for c in t) for t, i in vocab.items()}
    sp = libraries()[1]
    b = {i: bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, sp.id_to_piece(i)) for i in range(len(sp)))}
    return a, b


def brute(rows):
    """The contract token by token: result rows with group texts."""
    (la, lb), (ta, tb) = libraries(), spelled()
    out, found = [], []
    for doc_id, text in rows:
        a = la.encode(" " + text, add_special_tokens=False).ids if text else []
        b = lb.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(ta[i] for i in a) != whole or b"".join(tb[i] for i in b) != whole:
            a, b = [], []
        spans = []
        for ids, table in ((a, ta), (b, tb)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(own)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        low, groups = 0, []
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, _, i in own if low <= s < cut) for own in spans))
            low = cut
        links, j = [], 0
        for s, e, i in spans[0]:
            while j and spans[1][j - 1][1] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][0] < e:
                if spans[1][j][1] > s:
                    links.append((i, spans[1][j][2]))
                j += 1
        out.append((doc_id, len(a), len(b), len(groups), ";".join(groups)))
        found.append(links)
    counts = Counter(p for links in found for p in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    full = []
    for (doc_id, n_a, n_b, n_groups, groups), links in zip(out, found, strict=True):
        full.append((doc_id, n_a, n_b, n_groups, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), groups))
    return sorted(full, key=repr)


@pytest.mark.parametrize("path", [A, B])
def test_ids_by_pieces_equal_the_library(path):
    side = tokens_of(Tokenizer(path))
    assert side.cut
    raw, places = contents(large(pa.array([" " + t for t in TEXTS])))
    ids, counts = side(raw, places)
    a, b = libraries()
    whole = [a.encode(" " + t, add_special_tokens=False).ids if path == A else b.encode(t) for t in TEXTS]
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    # a text that is empty has no place in a result
    assert [g for g, t in zip(got, TEXTS, strict=True) if t] == [w for w, t in zip(whole, TEXTS, strict=True) if t]


@pytest.mark.parametrize("most", [0, 2_000_000])
def test_equals_brute_force(spark, odd, odd_rows, most):
    rows = [(i, t) for i, t, _ in odd_rows] + [(1000 + i, t) for i, t in enumerate(TEXTS)]
    extra = spark.createDataFrame([(1000 + i, t, None) for i, t in enumerate(TEXTS)], "doc_id long, text string, source string")
    df = odd.unionByName(extra, allowMissingColumns=True).selectExpr("*", *[f"'x' as {c}" for c in ("a", "b", "times", "row", "groups", "pair", "n_a")])
    wanted = brute(rows)
    got = align(df, Tokenizer(A), Tokenizer(B), Alignment(), broadcast_pairs=most).collect()
    assert sorted((tuple(r) for r in got), key=repr) == wanted
    if most:
        digests = align(df, Tokenizer(A), Tokenizer(B), Alignment(groups="sha256")).collect()
        hashed = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in wanted]
        assert sorted((tuple(r) for r in digests), key=repr) == sorted(hashed, key=repr)


def test_empty_table_and_texts_without_tokens(spark, empty):
    assert align(empty, Tokenizer(A), Tokenizer(B)).collect() == []
    none = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert sorted(map(tuple, align(none, Tokenizer(A), Tokenizer(B)).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
