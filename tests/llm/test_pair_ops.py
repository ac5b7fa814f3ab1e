"""SimHash groups, line classes and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from searchrank.llm import components, line_dedup, simhash_dedup


def union_find(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1200)]
    edges += [(5000, k) for k in range(5001, 5200)] + edges[:5] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {x["node"]: x["root"] for x in components.components(df).collect()}
    want = union_find({n for e in edges for n in e if e[0] != e[1]}, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert components.components(df.limit(0)).count() == 0


def slow_fingerprint(text):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace(
        "\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if x]
    if not w:
        return 0
    s = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_triples_cover_every_four_positions():
    from itertools import combinations
    assert len(simhash_dedup.TRIPLES) == 20
    assert all(any(set(t) <= set(q) for t in simhash_dedup.TRIPLES) for q in combinations(range(8), 4))


@pytest.mark.parametrize("block", [2048, 3])
def test_simhash_links(spark, block):
    r = random.Random(2)
    fps = set()
    for _ in range(60):
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 2, 25])):
            fps.add(x)
            for _ in range(r.choice([1, 3, 4, 6])):
                x ^= 1 << r.randrange(64)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = [(x["a"], x["b"]) for x in simhash_dedup.near_links(df, block=block).collect()]
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in links)
    assert union_find(signed, links) == union_find(signed, near)


def test_simhash_documents(spark):
    r = random.Random(3)
    base = [" ".join(f"w{r.randrange(500)}" for _ in range(n)) for n in (1, 2, 3, 4, 5, 80, 300, 300)]
    texts = base + [b.replace("w1 ", "W1\t") for b in base] + [b + " tail" for b in base[5:]]
    texts += [None, "", " \n\x0b", "É é", "a" * 200_000]
    rows = [(i, t, "x", 9) for i, t in enumerate(texts)] + [(3, texts[3], "x", 9), (None, texts[7], "x", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id long")
    got = simhash_dedup.near_duplicates(df).collect()
    fp = {i: slow_fingerprint(t) for i, t in enumerate(texts)}
    assert len(got) == len(rows)
    near = [(i, j) for i in fp for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 4]
    want = union_find(fp, near)
    for x in got:
        i = 7 if x["doc_id"] is None else x["doc_id"]
        assert x["fp"] & (2**64 - 1) == fp[i] and x["component_id"] == want[i]
    assert simhash_dedup.near_duplicates(df.limit(0)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(r, s, n):
    s = list(s)
    for _ in range(n):
        k = r.randrange(len(s) + 1)
        kind = r.choice("ids")
        if kind == "i" or not s:
            s.insert(k, r.choice("abé"))
        elif kind == "d":
            del s[min(k, len(s) - 1)]
        else:
            s[min(k, len(s) - 1)] = r.choice("abé")
    return "".join(s)


@pytest.mark.parametrize("t", [1, 2, 3])
def test_banded_distance(t):
    r = random.Random(t)
    pairs = []
    for _ in range(1500):
        a = "".join(r.choice("abé") for _ in range(r.randrange(0, 45)))
        pairs.append((a, edited(r, a, r.randrange(0, 6))))
    got = line_dedup.within([line_dedup._codes(a) for a, _ in pairs], [line_dedup._codes(b) for _, b in pairs], t)
    assert got.tolist() == [distance(a, b) <= t for a, b in pairs]


def near_lines(r, n=50):
    out = []
    for _ in range(n):
        s = "".join(r.choice("abcdefgh ") for _ in range(r.randrange(20, 60))).strip() + "." * 4
        out.append(s)
        for _ in range(r.choice([0, 1, 4])):
            out.append(edited(r, s, r.choice([1, 2, 3])))
    hub = "the very same line that stands in many places, more or less"
    return out + [edited(r, hub, 1) for _ in range(60)]


@pytest.mark.parametrize("block", [4096, 7])
def test_line_links(spark, block):
    r = random.Random(9)
    lines = list(dict.fromkeys(x for x in near_lines(r) if len(x) >= 20))
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)] * 2, "id long, line string")
    links = [(x["a"], x["b"]) for x in line_dedup.line_links(df, block=block).collect()]
    near = [(i, j) for i in range(len(lines)) for j in range(i)
            if abs(len(lines[i]) - len(lines[j])) <= 2 and distance(lines[i], lines[j]) <= 2]
    assert union_find(range(len(lines)), links) == union_find(range(len(lines)), near)


def test_line_dedup_documents(spark):
    long = "x" * 30_000
    a, b = "A line of some length that comes again.", "Another line, and it is here only once."
    texts = {0: f"{a}\n{b}\nshort", 1: f"{a[:-1]}!\nshort\nshort", 2: f" {a} \r\n{a}\nonly here, this one line", 3: None,
             4: "", 5: "\n\n", 6: f"{long}y\n{b.upper()}", 7: f"{long}z"}
    rows = [(k, t, 1, "c") for k, t in texts.items()] + [(2, texts[2], 1, "c"), (None, "A line of some lngth that comes again.", 1, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, gone string")
    got = line_dedup.deduplicate(df).collect()
    assert len(got) == len(rows)
    text = {}
    for x in got:
        text.setdefault(x["doc_id"], set()).add(x["clean_text"])
    assert text == {None: {"A line of some lngth that comes again."}, 0: {f"{b}\nshort"}, 1: {"short\nshort"},
                    2: {"only here, this one line"}, 3: {None}, 4: {""}, 5: {"\n\n"}, 6: {texts[6]}, 7: {""}}
    first = {x["doc_id"]: {g["first_doc"] for g in x["gone"]} for x in got}
    assert first[1] == {None} and first[7] == {6} and first[3] == set()
    assert line_dedup.deduplicate(df.limit(0)).count() == 0


def test_documents_of_one_hot_line(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("This line is found in every document.\nNumber "), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    got = line_dedup.deduplicate(df)
    assert got.where(F.size("gone") == 1).count() == 2999
    assert got.where("clean_text like 'This%'").count() == 1


def test_passages_across_line_breaks(spark):
    r = random.Random(2)
    word = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(3, 9))) for _ in range(400)]
    said = [" ".join(r.choice(word) for _ in range(20)).capitalize() + "." for _ in range(6)]
    own = [" ".join(r.choice(word) for _ in range(20)).capitalize() + "." for _ in range(6)]
    passage = " ".join(said)
    cut = passage.split(" ")
    other = said[0].split(" ")
    other[9] = "somethingelse"
    far = other[:]
    far[3] = "different"
    texts = {0: passage, 1: own[0] + "\n" + "\n".join(" ".join(cut[i:i + 7]) for i in range(0, len(cut), 7)),
             2: f"{own[1]} {passage} {own[2]}", 3: " ".join(other) + f"\n{own[3]}", 4: " ".join(far) + f"\n{own[4]}", 5: own[5]}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"]: x for x in line_dedup.deduplicate(df).collect()}
    clean = {k: x["clean_text"] for k, x in got.items()}
    # one word in sixteen: 3 is a copy of 0, and 4 is linked through 3
    assert clean == {0: passage, 1: own[0], 2: f"{own[1]} {own[2]}", 3: own[3], 4: own[4], 5: own[5]}
    assert [g["first_doc"] for g in got[2]["gone_parts"]] == [0] * 6 and got[2]["gone"] == []


def test_word_links(spark):
    r = random.Random(5)
    lines = []
    for n in (14, 16, 31, 32, 50, 90):
        for _ in range(6):
            a = [r.choice("abcdefghijklmnop") for _ in range(n)]
            lines.append(" ".join(a))
            for k in (1, 2, 3, 5, 6):
                b = a[:]
                for at in r.sample(range(n), k):
                    b[at] = r.choice(["Z", "Y", "X Y", ""])
                lines.append(" ".join(" ".join(b).split()))
    lines = list(dict.fromkeys(lines))
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    links = [(x["a"], x["b"]) for x in line_dedup.line_links(line_dedup.word_lines(df), 1, grow=16).collect()]
    words = [x.split() for x in lines]
    near = [(i, j) for i in range(len(lines)) for j in range(i) if min(len(words[i]), len(words[j])) >= 16
            and abs(len(words[i]) - len(words[j])) <= 5
            and distance(words[i], words[j]) <= min(5, min(len(words[i]), len(words[j])) // 16)]
    assert union_find(range(len(lines)), links) == union_find(range(len(lines)), near)


def test_line_dedup_reads_texts_a_few_times(spark):
    """Both distances share the passes for index, keys, texts and places (F1): two reads each, and one for the result."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    text = "The first line of some length.\nThe first line of some lengths.\n" + " ".join(f"word{i}" for i in range(40)) + "."
    docs = spark.createDataFrame([(i, text + f"\nOnly document {i * 7919} has this line.") for i in range(10)],
                                 "doc_id long, text string").repartition(2)
    got = line_dedup.deduplicate(docs.mapInArrow(count, docs.schema)).collect()
    assert sorted(r["doc_id"] for r in got if len(r["gone"]) > 1) == list(range(1, 10))
    assert seen.value <= 9 * 10
