"""Order MinHash: the signature by hand, edited texts, texts without blanks, successors."""

import hashlib
import random
import re
from collections import Counter

import numpy as np

from tallyloom.llm import omh
from tallyloom.llm.common import Words

from .conftest import DOCS, passage


def sign(text):
    return omh._signatures([text])[0]


def test_falls_with_edits_and_with_order():
    rng = random.Random(1)
    words = [f"w{rng.randrange(300)}" for _ in range(400)]
    own = sign(" ".join(words))
    near = []
    for edits in (0, 5, 40, 200):
        changed = list(words)
        for i in rng.sample(range(400), edits):
            changed[i] = f"e{i}"
        near.append(omh.likeness(own, sign(" ".join(changed))))
    assert near[0] == 1.0 and near == sorted(near, reverse=True) and near[-1] < 0.2
    moved = words[200:] + words[:200]
    assert omh.likeness(own, sign(" ".join(moved))) < 0.75  # the same k-mers, but for the seam
    assert (sign("") == sign(" \n")).all() and omh.likeness(sign("a b"), sign("a b c")) < 1


MASK = 2**64 - 1


def scramble(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def by_hand(text):
    """The signature in plain Python: tokens, k-mers, numbers, the smallest hashes in text order."""
    tokens = []
    for word in re.findall(rb"[^\x20\x09-\x0D]+", text.encode()):
        start = 0
        for i in range(3, len(word)) if len(word) > omh.LONG_WORD else ():
            if word[i] & 0xC0 != 0x80 and scramble(
                (int.from_bytes(word[i - 3 : i], "big") + int(omh._STEP)) & MASK
            ) % 4 == 0:
                tokens.append(word[start:i])
                start = i
        tokens.append(word[start:])
    if not tokens:
        return [0] * omh.TUPLES
    code = {t: int(Words([t.decode("utf-8", "replace")]).codes[0]) for t in set(tokens)}
    k = min(omh.K, len(tokens))
    base, seen = [], Counter()
    for i in range(len(tokens) - k + 1):
        gram = code[tokens[i]]
        for t in tokens[i + 1 : i + k]:
            gram = (gram * 0xD6E8FEB86659FD93 + code[t]) & MASK
        gram = scramble(gram)
        base.append(scramble((gram + seen[gram] * int(omh._STEP)) & MASK))
        seen[gram] += 1
    out = []
    for factor in map(int, omh._FACTORS[: omh.TUPLES]):
        smallest = sorted(range(len(base)), key=lambda i: (base[i] * factor & MASK, i))[: omh.PICKED]
        value = factor
        for i in sorted(smallest):
            value = scramble((value * int(omh._STEP) + base[i]) & MASK)
        out.append(value >> 32)
    return out


HAN = "".join(random.Random(8).choices([chr(0x4E00 + i) for i in range(900)], k=3000))


def test_signature_by_hand(texts):
    given = ["", " \n", "a", "a b", "a b c", "a a a a a a a a", HAN[:300], "x" * 70, "u" * 24 + " " + "v" * 25,
             "https://example.org/a/long/path?with=query&and=more " * 3, "\u0434" * 30 + " end", passage(1, 60)]
    given += [t or "" for t in list(texts.values())[:25]]
    together = omh._signatures(given)
    for text, got in zip(given, together, strict=True):
        assert got.tolist() == by_hand(text)
        assert (got == sign(text)).all()  # whatever else stands in the batch


def test_texts_without_blanks():
    rng = random.Random(3)
    latin = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6000))
    for text in (HAN, latin):
        own, near = sign(text), []
        for edits in (1, 20, 300):
            changed = list(text)
            for i in rng.sample(range(len(text)), edits):
                changed[i] = "\u4e8c" if text is HAN else "Q"
            near.append(omh.likeness(own, sign("".join(changed))))
        assert near[0] > 0.9 and near == sorted(near, reverse=True) and near[-1] < 0.6
        half = len(text) // 2
        assert omh.likeness(own, sign(text[half:] + text[:half])) < 0.75
        assert omh.likeness(own, sign(text[:-1])) > 0.9


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = sign(t), sign(edited), sign(after)
        text = lambda s: s.astype(">u4").tobytes().hex()
        out.append((d, len(t), edited, text(a), text(b), omh.likeness(a, b), omh.likeness(a, c)))
    return sorted(out, key=str)


def test_odd_rows(odd, none):
    got = sorted(map(tuple, omh.edited_pairs(odd).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert omh.edited_pairs(none).count() == 0
    prints = omh.fingerprints(odd).select("text", "fingerprint").distinct().collect()
    assert len({r.text for r in prints}) == len(prints)
    assert omh.fingerprints(none).count() == 0


def test_single_row(spark):
    df = spark.createDataFrame([(5, "a b c d", *[None] * 8)], DOCS)
    assert omh.edited_pairs(df).first().edited_text == "a b a b"


def test_query(spark, sf_dir, texts):
    from __spark_entry__ import queries

    rows = queries()["op9_order_minhash"](spark, sf_dir).collect()
    want = [
        (d, n, hashlib.sha256(e.encode()).hexdigest(), *rest) for d, n, e, *rest in brute(texts.items())
    ]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95


def test_many_cells_at_a_time(monkeypatch):
    text = passage(1, 500)
    whole = sign(text)
    monkeypatch.setattr(omh, "_CELLS", 1_000)
    assert (sign(text) == whole).all()
