"""Chat formatting, decontamination, quality rules and URL rules against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from searchrank.llm import chat_format, decontaminate, quality_rules, queries, url_filter

DOCS = "doc_id long, text string, lang string, n_words long, spans string"


def test_chat_round_trip(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<|\\im_end|>", "<|\\\\im_start|>\n<|im_end|>\n", "", None, "<|im_",
             "end<|im_end|", "é漢😀<|im_start|>", "\n\n", "plain"]
    rows = [(c, t, random.Random(c * 99 + t).choice(["user", "assistant", "a\nb", "<|im_end|>", "%0A", None]),
             nasty[(c + t) % len(nasty)], "x") for c in range(12) for t in range(7)]
    rows += rows[:3] + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat_format.loss_text(chat_format.format_conversations(df))
    got = {r["conv_id"]: r for r in out.withColumn("read", chat_format.parse(F.col("formatted"))).collect()}
    assert len(got) == 13
    for c, r in got.items():
        want = sorted(((t is not None, t or 0, role or "", text or "") for cc, t, role, text, _ in rows if cc == c))
        want = [(role, text) for *_, role, text in want]
        assert [(x["role"], x["text"]) for x in r["read"]] == want
        assert r["loss_text"] == "".join(t for role, t in want if role == "assistant")
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == len(want)
        for s in r["loss_spans"]:
            raw = r["formatted"].encode()[s["byte_start"]:s["byte_end"]].decode()
            assert raw == r["formatted"][s["start"]:s["end"]]
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_chat_many_turns(spark):
    df = spark.range(5000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                  F.lit("assistant").alias("role"), F.lit("<|im_end|> é").alias("text"))
    r = chat_format.loss_text(chat_format.format_conversations(df)).first()
    assert r["loss_text"] == "<|im_end|> é" * 5000 and r["n_escaped"] == 5000


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, it in items:
            x = words(it)
            n = min(10, len(x))
            for a in range(len(x) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b:b + n] == x[a:a + n]:
                        hit |= set(range(b, b + n))
                        found.add(i)
        out.append((d, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [True, False])
def test_decontamination(spark, small):
    r = random.Random(5)
    items = [(i, " ".join(r.choice("abÉc") for _ in range(r.choice([12, 15, 30])))) for i in range(6)]
    items += [(6, "Q r s"), (7, "zz"), (8, None), (9, "!!"), (None, "m n o p q r s t u v w"), (6, "Q r s")]
    docs = [(d, " ".join(r.choice("abÉc") for _ in range(r.choice([0, 4, 9, 10, 11, 60])))) for d in range(25)]
    docs += [(30, f"x-{items[0][1].upper()}. y"), (31, "q R, s! q r s zz"), (32, None), (33, ""), (None, items[1][1]),
             (30, f"x-{items[0][1].upper()}. y"), (30, "other"), (34, "m n o p q r s t u v w x"),
             (35, " ".join(f"{items[2][1]} gap{k}" for k in range(40)))]
    df = spark.createDataFrame([(*d, "en", 1, "s") for d in docs], DOCS)
    it = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(df, it, broadcast_rows=1_000 if small else 0).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got], key=str) == brute(docs, items)
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in got)
    assert decontaminate.find_contamination(df.limit(0), it).count() == 0
    clean = decontaminate.find_contamination(df, it.limit(0))
    assert clean.where("contaminated").count() == 0 and clean.count() == len(docs)


def base_rules(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    rep = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(rep),
            len(w) < 50 or 100 * len(rep) > 50 * len(w))


def test_quality_rules(spark):
    r = random.Random(3)
    texts = [None, "", " \n\t", "a b c", "a b c a b c", "a a a a a", "x\nx\n x\n\n\nx", "é# *$ |<>"]
    texts += [" ".join(r.choice("abcdefgh") for _ in range(n)) for n in (3, 4, 49, 50, 51, 400, 3000)]
    texts += ["\n".join(["Fine words stand here in one quiet line."] * 3 + [f"Line {i} says so." for i in range(30)])] * 2
    df = spark.createDataFrame([(i, t, "en", 5, "z") for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(df).collect()}
    for i, t in enumerate(texts):
        g = got[i]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"],
                g["base_failed"]) == base_rules(t), t
    assert quality_rules.apply_rules(df.limit(0)).count() == 0


def test_quality_lines(spark):
    r = random.Random(8)
    good = "\n".join(" ".join(f"word{r.randrange(900)}" for _ in range(9)) + "." for i in range(12))
    shout = "\n".join(["REALLY!! BUY!! NOW!! %%%"] * 8)
    menu = "\n".join("Home | News | Shop | About us | Contact" for _ in range(30))
    df = spark.createDataFrame([(0, good), (1, good + "\n" + shout), (2, "Short one.\n" + menu + "\n" + good[:90]),
                                (3, good + "\nAll rights reserved by them.")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(df).collect()}
    assert got[0]["cleaned"] == good and got[0]["kept"]
    assert got[1]["cleaned"] == good and got[1]["n_lines_removed"] == 8
    assert not got[2]["kept"]
    assert got[3]["cleaned"] == good and got[3]["kept"]


def test_url_rules(spark):
    urls = ["https://a.com/x", "http://COM/", "https://a.com", "https://m.example.com/en/25#top", "https://x.net/es/1",
            "https://www.example.com/en/9?x=1", "http://sub.www.example.com/en/", "http://notexample.com/en/", None, "",
            "nothing", "ftp://u@h.net/fr", "ftp://h.net/fr/?a=1&b=2&&c", "x://é.org/ä/#?q", "http://net/es/", "a://b://c.net/es/",
            "http://1.2.3.4:80/a/b\nc?d"]
    df = spark.createDataFrame([(i, u, "r", "h") for i, u in enumerate(urls)],
                               "page_id long, url string, rule string, host string")
    rules = queries.URL_RULES
    got = {r["page_id"]: r for r in url_filter.judge(df, rules, rounds=2).collect()}
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(p), p, v) for v, p in rules
                if ("." + host).endswith("." + p.split("/", 1)[0]) and path.startswith("/" + p.split("/", 1)[1])]
        g = got[i]
        assert (g["host"], g["path"]) == (host, path), u
        assert g["rule"] == (max(fits)[1] if fits else None), u
        assert g["verdict"] == max(fits)[2] if fits else g["verdict"] in ("allow", "block")
    assert url_filter.judge(df.limit(0), rules).count() == 0
    only = url_filter.judge(df, [("block", "net/")])
    assert {r["verdict"] for r in only.collect()} == {"block"}
    assert {r["verdict"] for r in url_filter.judge(df, []).collect()} == {"allow"}


def test_url_trees_decide_where_no_rule_fits(spark):
    rules = (("allow", "good.com/"), ("block", "evil.com/"))
    words = ["news", "sport", "about", "house"]
    rows = []
    for i in range(400):
        plain, odd = f"/{words[i % 4]}/{words[i // 4 % 4]}", f"/x{i * 7919 % 100003}{i}/{i * 31}?a={i}&b=2&c=9"
        rows += [(f"https://good.com{plain}{'a' * (i % 9)}",), (f"https://evil.com{odd}",),
                 (f"https://free.com{plain}{'b' * (i % 9)}",), (f"https://free.com{odd}",)]
    rows += [rows[0], rows[0], ("https://free.com/" + "a" * 200_000,), (None,)]
    df = spark.createDataFrame([(i, u) for i, (u,) in enumerate(rows)], "page_id long, url string")
    got = {x["page_id"]: x["verdict"] for x in url_filter.judge(df, rules).collect()}
    assert len(got) == len(rows)
    free = [i for i, (u,) in enumerate(rows[:1600]) if "free.com" in u]
    assert all(got[i] == ("block" if "?a=" in rows[i][0] else "allow") for i in free)
    lexical = [f for f in url_filter.FEATURES if not f.startswith("f_suffix")]
    assert url_filter.evaluate(df, rules, lexical) > 0.99
    assert url_filter.evaluate(df, (("allow", "com/"),)) is None
