"""Spelling variants, packing and collocations against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from searchrank.llm import collocations, packing, spelling_variants


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_words(docs, min_chars, min_count, misspell):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = low(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if misspell and h % misspell == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= min_chars:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def slow_variants(n, ratio=10):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root)
    return out


def variants_of(df, **kw):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"])
            for r in spelling_variants.spelling_variants(df, **kw).collect()}


@pytest.mark.parametrize("block", [4096, 3])
def test_variants_equal_brute_force(spark, block):
    r = random.Random(4)
    n = {}
    for _ in range(60):
        w = "".join(r.choice("abé") for _ in range(r.randrange(1, 9)))
        for _ in range(12):
            n[w] = r.choice([1, 2, 5, 30, 400, 10**12])
            at = r.randrange(len(w) + 1)
            w = r.choice([w[:at] + r.choice("abc") + w[at:], w[:at] + r.choice("abd") + w[at + 1:], w[:at] + w[at + 1:]]) or "a"
    df = spark.createDataFrame([*n.items(), (None, 3)], "word string, n long")
    assert variants_of(df, block=block) == slow_variants(n)


def test_variant_chains_ties_and_hot_prefix(spark):
    n = {"aaaaaaaa": 10**6, "aaaaaaab": 10**5, "aaaaaabb": 10**4, "aaaaabbb": 10**3, "aaaabbbb": 100, "aaabbbbb": 10,
         "aabbbbbb": 1, "zzzzzzz": 1, "zzzzzzy": 50, "zzzzzzx": 50}
    n |= {"prefix" + x + y + z: 7 for x in "abcdefgh" for y in "abcdefgh" for z in "abcdefgh"}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = variants_of(df, block=16)
    assert got == slow_variants(n)
    assert got["aabbbbbb"][4] == "aaaaaaaa" and got["zzzzzzz"][2] == "zzzzzzx"
    assert spelling_variants.spelling_variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling_variants.spelling_variants(df, ratio=1)


def test_corpus_words(spark):
    r = random.Random(5)
    pool = ["Straßenbahn", "ÉCOLE", "naïveté", "reading", "Readings", "x", "écolesécoles", "abcdefg", "×÷×÷×÷×", "ŁódźŁódź"]
    docs = [(i, " ".join(r.choice(pool) for _ in range(80)) + r.choice(["-", "1", "中", "\n"])) for i in range(120)]
    docs += [(None, "abcdefg abcdefg"), (5, None), (6, ""), (7, "reading " * 60_000), docs[0], docs[0]]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, word int")
    for misspell in (None, 31, 2):
        got = {x["word"]: x["n"] for x in spelling_variants.corpus_words(df, misspell=misspell).collect()}
        assert got == slow_words(docs, 7, 2, misspell)
    assert spelling_variants.corpus_words(df.limit(0)).count() == 0


def ids_of():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.vocabulary_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer():
    r, slow, fast = random.Random(6), ids_of(), packing.Ids(packing.vocabulary_path())
    letters = [chr(c) for c in (*range(0x250), 0x3000, 0x2028, 0x4e2d, 0x1f600, 0x300, 0x661)]
    for i in range(1500):
        s = "".join(r.choice(letters if i % 2 else "ab'st 12 \n\té!.") for _ in range(r.randrange(40)))
        assert fast(s).tolist() == slow(s)
    for s in ("<|endoftext|>a<|endoftext|>", "a" * 50_000, " " * 50_000 + "x", "é　" * 9_000):
        assert fast(s).tolist() == slow(s)


def slow_best_fit(lengths, tokens):
    """Best-fit decreasing, piece by piece."""
    free = []
    for n in sorted(lengths, reverse=True):
        at = min((i for i, f in enumerate(free) if f >= n), key=lambda i: free[i], default=None)
        if at is None:
            free.append(tokens)
            at = len(free) - 1
        free[at] -= n
    return len(free)


@pytest.mark.parametrize("rule", packing.RULES)
def test_plan_equals_piecewise_best_fit(rule):
    r = random.Random(7)
    for tokens in (10, 64, 1024):
        for many in (0, 1, 30, 900):
            lengths = [min(tokens, 1 + int(r.expovariate(3 / tokens))) for _ in range(many)]
            plan = packing.Plan(Counter(lengths), tokens, rule=rule)
            assert plan.sequences == slow_best_fit(lengths, tokens)
            check_places(plan, lengths, tokens, tokens, tokens ** 2)


def check_places(plan, lengths, tokens, documents, cost):
    rank, seen = [], Counter()
    for n in lengths:
        rank.append(seen[n])
        seen[n] += 1
    seq, off = plan.place(np.array(lengths, dtype=np.int64), np.array(rank, dtype=np.int64))
    by = defaultdict(list)
    for n, s, o in zip(lengths, seq.tolist(), off.tolist()):
        by[s].append((o, n))
    assert sorted(by) == list(range(plan.sequences))
    for held in by.values():
        at = 0
        for o, n in sorted(held):
            assert o == at
            at += n
        assert at <= tokens and len(held) <= documents and sum(n * n for _, n in held) <= cost


@pytest.mark.parametrize("rule", packing.RULES)
def test_every_capacity_binds(rule):
    r = random.Random(8)
    lengths = [r.choice([1, 2, 3, 20, 33, 60]) for _ in range(700)]
    for documents, cost in ((4, None), (None, 4000), (6, 5000)):
        plan = packing.Plan(Counter(lengths), 100, documents, cost, rule)
        check_places(plan, lengths, 100, documents or 100, cost or 10_000)
        least = max(sum(lengths) / 100, len(lengths) / (documents or 100), sum(n * n for n in lengths) / (cost or 10_000))
        assert least <= plan.sequences <= 1.25 * least + 2


def test_plan_size_does_not_grow_with_the_counts():
    lengths = Counter({n: 1 + n * n % 7 for n in range(1, 1025)})
    big = Counter({n: k * 10**9 for n, k in lengths.items()})
    plan = packing.best_plan(big)
    assert sum(len(s[0]) for s in plan.slots.values()) < 40_000
    assert plan.sequences <= 1.01 * sum(n * k for n, k in big.items()) / 1024


def test_pack_documents(spark):
    r = random.Random(9)
    docs = [(i, " ".join(r.choice(["a", "reading", "çé", "12"]) for _ in range(r.choice([0, 1, 5, 40, 90])))) for i in range(150)]
    docs += [(None, "no id"), (7, None), (8, ""), (9, "x <|endoftext|> y " * 4000), docs[3], docs[3]]
    df = spark.createDataFrame([(*d, "c", 1) for d in docs], "doc_id long, text string, ids string, offset int").repartition(7)
    got = packing.pack(df, tokens=64, documents=9, with_ids=True).cache()
    rows = got.collect()
    slow = ids_of()
    want = Counter()
    for doc, text in docs:
        ids = [*slow(text), packing.END_ID]
        first = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, k, a, tuple(ids[a:b]), zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((x["doc_id"], x["piece"], x["start"], tuple(x["ids"]), x["ids_crc32"]) for x in rows) == want
    assert all(len(x["ids"]) == x["length"] for x in rows)
    by = defaultdict(list)
    for x in rows:
        by[x["sequence_id"]].append((x["offset"], x["length"]))
    for held in by.values():
        assert [o for o, _ in sorted(held)] == [sum(n for _, n in sorted(held)[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) <= 64 and len(held) <= 9
    seqs = packing.sequences(got).collect()
    assert {x["sequence_id"]: len(x["ids"]) for x in seqs} == {s: sum(n for _, n in h) for s, h in by.items()}
    assert packing.pack(df.limit(0)).count() == 0
    assert {x["length"] for x in packing.pack(df.limit(3), tokens=64, cost=100).collect()} <= set(range(11))
    with pytest.raises(ValueError):
        packing.pack(df, tokens=0)


def slow_collocations(docs, min_count, top):
    f, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", low(text or "")):
            w = [x for x in re.split("[ \t]", piece) if x]
            total[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, n in f.items():
        cand = {p: a for p, a in n.items() if len(p) > 1 and a >= min_count}
        hidden = set()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= 80 * n[p[i:i + k]]:
                        hidden.add(p[i:i + k])
        rows = []
        for p, a in cand.items():
            if p not in hidden:
                score, k = min((2_000_000 * a // (n[p[:k]] + n[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), n[p[:k]], n[p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("bits", [None, 3, 16])
def test_collocations_equal_brute_force(spark, bits):
    r = random.Random(10)
    words = ["the", "New", "york", "city", "hall", "é", "of", "É", "a-b", "中文"]
    docs = []
    for i in range(200):
        w = []
        for _ in range(60):
            w.append(r.choice([r.choice(words), "new york", "New York city hall", f"rare{r.randrange(900)}", "the the the"]))
            w.append(r.choice([" ", " ", " ", "\t", ", ", ".\n", "  ", "\x0b"]))
        docs.append((r.choice(["en", "en", "de", None, ""]), "".join(w)))
    docs += [("en", None), ("en", ""), ("xx", " ,. "), (None, "of the " * 5000), docs[0], docs[0]]
    df = spark.createDataFrame([(*d, 1, "n") for d in docs], "lang string, text string, n int, phrase string")
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(tuple(x[c] for c in names) for x in collocations.collocations(df, min_count=5, top=40, bits=bits).collect())
    assert got == slow_collocations(docs, 5, 40)
    assert collocations.collocations(df.limit(0)).count() == 0
    one = spark.createDataFrame([("en", "x"), ("de", ".")], "lang string, text string").repartition(2)
    assert collocations.collocations(one, min_count=1).count() == 0


def test_collocation_scores_pass_64_bits(spark):
    from searchrank.llm.collocations import F
    a = 9 * 10**17
    got = spark.range(1).select(F.expr(
        f"CAST(2000000 AS decimal(7,0)) * CAST({a}L AS decimal(20,0)) div (CAST({a}L AS decimal(20,0)) + CAST({a + 1}L AS decimal(20,0)))"))
    assert got.first()[0] == 2_000_000 * a // (2 * a + 1)
