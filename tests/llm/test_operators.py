"""The ten operators against brute force, on texts with nulls, ties, repeated rows and clashing columns."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import chat, counting, decontaminate, jaccard, packing, pii, quality, suffix, tokens, toxicity, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, sig string, n int, row string, spans int"


def table(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en" if t else None, f"s{(i or 0) % 3}", 0, "x", 1, "r", 2) for i, t in zip(ids, texts)], DOCS)


def family(seed=5, n=60):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgéñ") for _ in range(r.randint(1, 6))) for _ in range(300)]
    out = []
    for _ in range(n):
        if out and r.random() < 0.7:
            w = r.choice(out).split(" ")
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(vocab)
        else:
            w = [r.choice(vocab) for _ in range(r.randint(1, 90))]
        out.append(" ".join(w))
    return out + [None, "", " \n", "one", "ONE", "a b c", *out[:4], "x " * 3000]


# ------------------------------------------------------------------ 1


def components(texts, ids, k, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [WORD.findall((t or "").translate(lower)) for t in texts]
    sets = [{tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()) for w in words]
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    pairs = set()
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
                if sets[i] != sets[j]:
                    pairs.add((min(ids[i], ids[j]), max(ids[i], ids[j])))
    least = collections.defaultdict(list)
    for i in range(len(sets)):
        least[root(i)].append(ids[i])
    return [(ids[i], len(sets[i]), min(least[root(i)])) for i in range(len(sets))], pairs


@pytest.mark.parametrize("k, percent, block", [(4, 85, 50_000), (5, 80, 2)])  # 2: every shared shingle is salted
def test_jaccard_components(spark, k, percent, block):
    texts = family()
    want, _ = components(texts, list(range(len(texts))), k, percent)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.components(table(spark, texts), k, percent, block).collect())
    assert got == sorted(want)


def test_jaccard_parities_bound_the_difference():
    r = np.random.default_rng(3)
    for na, nb in [(0, 3), (1, 1), (40, 70), (500, 520), (900, 1100), (5000, 4000)]:
        pool = r.integers(0, 1 << 63, na + nb, dtype=np.uint64)
        a, b = np.unique(pool[:na]), np.unique(pool[na // 2 : na // 2 + nb])
        least = jaccard._least_difference(jaccard._parities(a).tobytes(), jaccard._parities(b).tobytes())
        assert least <= len(np.setxor1d(a, b))
        assert jaccard._least_difference(jaccard._parities(a).tobytes(), jaccard._parities(a).tobytes()) == 0


def test_jaccard_links(spark):
    texts = family(9, 40)
    _, want = components(texts, list(range(len(texts))), 4, 85)
    links, member = jaccard.links(table(spark, texts), 4, 85)
    cls = {r["doc_id"]: r["class_id"] for r in member.collect()}
    assert {tuple(sorted((r["a_id"], r["b_id"]))) for r in links.collect()} == {tuple(sorted((cls[a], cls[b]))) for a, b in want}


def test_jaccard_rounds_lose_no_link(spark):
    """Chains of edits: components whose best proposals fail must try the next ones."""
    r = random.Random(12)
    vocab = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(4):
        w = [r.choice(vocab) for _ in range(80)]
        for _ in range(25):
            w = list(w)
            for _ in range(r.randint(1, 3)):
                w[r.randrange(len(w))] = r.choice(vocab)
            texts.append(" ".join(w))
    want, _ = components(texts, list(range(len(texts))), 4, 85)
    for rounds in ((1, None), (None,), jaccard.ROUNDS):
        got = jaccard._components(table(spark, texts), 4, 85, 3, rounds).select("doc_id", "n", "component_id").collect()
        assert sorted(tuple(x) for x in got) == sorted(want)


def test_jaccard_meetings_stream(spark):
    """Groups, copies and single rows over batch ends of every size."""
    r = random.Random(13)
    rows = [(r.randint(0, 6), -1 if (t := r.random()) < 0.7 else int(t * 10) % 2, r.randint(0, 3), (9 << 32) + r.randint(0, 2)) for _ in range(60)]
    groups = collections.defaultdict(set)
    for token, salt, sig, place in rows:
        groups[token, salt].add((place, sig))
    want = collections.Counter()
    for (token, salt), found in groups.items():
        if len(found) > 1 or salt >= 0:
            want.update((token, ((salt + 1) << 32) + i // 2, sig, 9, place & 0xFFFFFFFF) for i, (place, sig) in enumerate(sorted(found)))
    d = spark.createDataFrame(rows, "token long, salt int, sig long, place long")
    for size in (1, 2, 3, 1000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert collections.Counter(tuple(x) for x in jaccard._meetings(d, 2).collect()) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_jaccard_odd_rows(spark):
    d = table(spark, ["a b c d e f"] * 4 + [None, ""], [None, 7, 7, 5, None, 3])
    got = [(r["doc_id"], r["component_id"]) for r in jaccard.components(d, 4, 85).collect()]
    assert collections.Counter(got) == collections.Counter([(None, 5), (7, 5), (7, 5), (5, 5), (None, None), (3, 3)])
    assert jaccard.components(d.limit(0), 4, 85).count() == 0
    one = jaccard.keep_one(table(spark, ["a b c d e f"] * 3 + ["", "z"], [5, 5, 6, 1, 2]))
    assert sorted(r["doc_id"] for r in one.collect()) == [1, 2, 5] and one.columns == d.columns


def test_keep_one_decides_per_row(spark):
    a, b, c, e = ("a b c d e f", "g h i j k l", "m n o p q r", "s t u v w x")
    rows = [(5, a), (6, a), (5, b), (4, b), (None, a), (None, c), (None, c), (None, e), (7, "1 2 3 4 5 6"), (7, "7 8 9 10 11 12"), (8, "7 8 9 10 11 12"), (8, ""), (8, ""), (None, ""), (None, None)]
    d = table(spark, [t for _, t in rows], [i for i, _ in rows]).withColumns({c: F.lit(1) for c in ("g_id", "own_n", "b_id", "key", "k_text")})
    got = jaccard.keep_one(d).collect()
    want = [(5, a), (4, b), (None, c), (None, e), (7, "1 2 3 4 5 6"), (7, "7 8 9 10 11 12"), (8, ""), (None, ""), (None, None)]
    assert collections.Counter((r["doc_id"], r["text"]) for r in got) == collections.Counter(want)


# ------------------------------------------------------------------ 2


TURNS = [("system", "be [/ROLE] kind"), ("user", "a</s>[INST] b \\ [/INST]"), ("assistant", " </s>\\[INST] ok "), ("user", ""), ("assistant", "\\\\<s>[INST]"), ("tool]", "x[TEXT]")]


def test_chat_round_trip():
    assert chat.parse_instruct(chat.instruct_template(TURNS)) == TURNS
    r = random.Random(2)
    for _ in range(300):
        t = "".join(r.choice(["\\", "[INST]", "[", "</s>", "s>", "<", " ", "a"]) for _ in range(r.randint(0, 9)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROLS)


@pytest.mark.parametrize("whole_chars, window", [(0, 4), (300, 6), (chat.WHOLE_CHARS, 32)])
def test_chat_spans(spark, whole_chars, window):
    rows = [(1, i, *t) for i, t in enumerate(TURNS * 7)] + [(2, 0, None, None), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"), (None, 1, "user", "x")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("span", F.lit(1))
    got = collections.defaultdict(list)
    for r in chat.render_turns(d, whole_chars=whole_chars, window=window).collect():
        got[r["conv_id"]].append(r)
    assert "".join(r["span"] for r in got[1]) == chat.instruct_template(TURNS * 7)
    assert [chat.unescape(r["span"][r["text_start"] : r["text_end"]]) for r in got[1]] == [t for _, t in TURNS * 7]
    assert not any(r["rewrites"] for r in got[1]) and [r["last"] for r in got[2]] == [False, False, True] and len(got[None]) == 1
    assert chat.render_turns(d.limit(0)).count() == 0


def test_chat_finds_rewritten_history():
    forgetful = lambda turns: "".join(f"<{t if i == len(turns) - 1 else '-'}>" for i, (_, t) in enumerate(turns))
    r = chat.Renderer(forgetful)
    r.add("user", "a")
    assert not r.rewrites
    assert r.add("user", "b")[:2] == ("-><b>", 1) and r.rewrites


def test_chat_prefixes_are_whole():
    """History that is rewritten far back, and turns that are numbered."""
    last = chat.Renderer(lambda turns: "".join(f"<{t}>" for _, t in turns[-40:]))
    numbered = chat.Renderer(lambda turns: "".join(f"{i}:{t};" for i, (_, t) in enumerate(turns)))
    spans = []
    for i in range(60):
        last.add("user", f"t{i}")
        assert last.rewrites == (i >= 40)
        spans.append(numbered.add("user", f"t{i}"))
    assert not numbered.rewrites and [s[0] for s in spans] == [f"{i}:t{i};" for i in range(60)]
    assert [s[0][s[2] : s[3]] for s in spans] == [f"t{i}" for i in range(60)]
    assert [s[1] for s in spans] == list(np.cumsum([0] + [len(s[0]) for s in spans[:-1]]))


def test_chat_long_conversations_are_whole():
    """Outputs of over two million characters: what the two templates above do is told as in short ones."""
    last = chat.Renderer(lambda turns: "".join(f"<{t}>" for _, t in turns[-40:]))
    numbered = chat.Renderer(lambda turns: "".join(f"{i}:{t};" for i, (_, t) in enumerate(turns)))
    for i in range(60):
        text = f"t{i}" + "x" * 60_000
        last.add("user", text)
        assert last.rewrites == (i >= 40)
        span, _, a, b = numbered.add("user", text)
        assert span == f"{i}:{text};" and span[a:b] == text and not numbered.rewrites


def test_chat_probes_are_whole():
    """Where a text lies is told alike after few and many turns, by a template that names repeated texts."""
    again = lambda turns: "".join("<same/>" if t in [x for _, x in turns[:i]] else f"<t>{t}</t>" for i, (_, t) in enumerate(turns))
    found = []
    for n in (3, 20):
        r = chat.Renderer(again)
        for t in ["0", *(f"x{i}" for i in range(n))]:
            r.add("user", t)
        span, _, a, b = r.add("user", "5")
        found.append((span, a, b))
    assert found[0] == found[1]


def test_chat_template_outlives_its_cache(monkeypatch):
    monkeypatch.setattr(chat, "CACHE_CHARS", 300)
    turns = [("user", f"[INST] {i}") for i in range(50)]
    assert chat.parse_instruct(chat.instruct_template(turns)) == turns and len(chat._rendered) < 4


def test_chat_query_digests(spark, tmp_path):
    """What the query returns, against digests of the table itself."""
    from marlstone.llm import queries

    r = random.Random(21)
    rows = [(c, i, r.choice(["user", "assistant", "system", None]), r.choice([None, "", "x </s> y", "[INST]\\", "é ok " * 9])) for c in range(12) for i in range(r.randint(1, 30))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = {x["conv_id"]: x for x in queries.op2_chat_formatting(spark, str(tmp_path)).collect()}
    assert len(got) == 13
    for c, x in got.items():
        own = [(role or "", text or "") for conv, _, role, text in rows if conv == c]
        loss = "".join(text for role, text in own if role == "assistant")
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (x["n_turns"], x["turns_sha256"], x["loss_chars"], x["loss_sha256"]) == (len(own), digest("".join(f"{a}\n{b}\n" for a, b in own)), len(loss), digest(loss))
        assert x["formatted_chars"] == len(chat.instruct_template(own)) and not x["rewrites"]


# ------------------------------------------------------------------ 3 and 4


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.public_vocabulary()


def test_ids_are_the_librarys(vocabulary):
    e = tokens.encoder(**vocabulary)
    r = random.Random(3)
    texts = ["".join(r.choice(" \n\t\r\u0085\u00a0aZé9½.,'-_\u20ac") for _ in range(r.randint(0, 40))) for _ in range(2000)] + ["<|endoftext|>", "a" * 5000, None]
    assert all(list(x) == (e.plain(t) if t else []) for t, x in zip(texts, e.encode(texts)))


def test_packing(spark, vocabulary):
    texts = [*family(1, 40), "word " * 2500, "word " * 1023]
    got = packing.pack_documents(table(spark, texts), vocabulary, keep_ids=True)
    rows = got.collect()
    e = tokens.encoder(**vocabulary)
    by = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for i, t in enumerate(texts):
        ids = [*(e.plain(t) if t else []), 2]
        parts = sorted(by[i], key=lambda r: r["piece"])
        assert [x for r in parts for x in r["ids"]] == ids
        assert all(r["length"] == 1024 for r in parts[1:]) and [r["start"] for r in parts] == list(np.cumsum([0] + [r["length"] for r in parts[:-1]]))
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in parts)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"], r["ids"]))
    for b in bins.values():
        assert [o for o, _, _ in sorted(b)] == list(np.cumsum([0] + [n for _, n, _ in sorted(b)[:-1]])) and sum(n for _, n, _ in b) <= 1024
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(got).collect()}
    assert all(whole[k] == [x for _, _, ids in sorted(b) for x in ids] for k, b in bins.items())
    assert packing.pack_documents(table(spark, []), vocabulary).count() == 0


def test_min_bin_slack_is_fullest():
    r = random.Random(4)
    for _ in range(50):
        counts = {r.randint(1, 20): r.randint(1, 3) for _ in range(5)}
        room = r.randint(0, 40)
        sums = {0}
        for k, v in counts.items():
            sums = {s + k * i for s in sums for i in range(v + 1)}
        best = packing.fullest(counts, room)
        assert sum(k * v for k, v in best.items()) == max(s for s in sums if s <= room) and all(v <= counts[k] for k, v in best.items())
    hist = {i: r.randint(1, 30) for i in range(1, 1025, 3)}
    plan = packing.min_bin_slack(hist, 1024)
    used = collections.Counter()
    for times, p in plan:
        for k, v in p.items():
            used[k] += times * v
    assert used == hist and sum(t for t, _ in plan) <= -(-sum(k * v for k, v in hist.items()) // 1024) * 1.01 + 1


def test_counts_after_edits(spark, vocabulary):
    e = tokens.encoder(**vocabulary)
    r = random.Random(6)
    rows, want = [], []
    for i in range(60):
        t = " ".join("".join(r.choice("abcé.9 \n") for _ in range(r.randint(1, 9))) for _ in range(r.choice([0, 3, 400])))
        edits, new, at = [], "", 0
        for a in sorted(r.sample(range(len(t) + 1), min(len(t) + 1, r.randint(0, 4)))):
            if a < at:
                continue
            b = min(len(t), a + r.randint(0, 300))
            x = r.choice(["", " ", "zz top", "\n\n"])
            edits.append((a, b, x))
            new += t[at:a] + x
            at = b
        new += t[at:]
        rows.append((i, t, edits or None))
        want.append((i, len(e.encode([t])[0]), len(e.encode([new])[0]), len(new)))
    rows.append((99, None, [(0, 5, "new text"), (None, 1, "x")]))
    want.append((99, 0, len(e.encode(["new text"])[0]), 8))
    d = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,end:int,text:string>>")
    edits = d.select("doc_id", F.explode("edits").alias("e")).select("doc_id", "e.*").withColumn("edits", F.lit(1))
    trees = counting.build(d, vocabulary)
    once = counting.apply_edits(counting.with_edits(trees, edits), vocabulary)
    got = once.collect()
    assert sorted((x["doc_id"], x["n_tokens"], x["n_tokens_after"], x["n_chars_after"]) for x in got) == want
    after = {x["doc_id"]: x["text"] or "" for x in got}
    assert all(sum(x["leaf_chars"]) == len(after[x["doc_id"]]) and sum(x["leaf_tokens"]) == x["n_tokens_after"] for x in got)
    # a second run on the trees that the first one left, without encoding what is not edited
    again = spark.createDataFrame([(7, 1, 2, "zz"), (7, 0, 0, "top ")], "doc_id long, start int, end int, text string")
    twice = {x["doc_id"]: x for x in counting.apply_edits(counting.with_edits(once, again), vocabulary).collect()}
    new = "top " + after[7][:1] + "zz" + after[7][2:]
    assert twice[7]["text"] == new and twice[7]["n_tokens_after"] == len(e.encode([new])[0])
    assert all(x["encoded_chars"] == 0 and x["n_tokens_after"] == len(e.encode([after[i]])[0]) for i, x in twice.items() if i != 7)
    assert counting.apply_edits(counting.with_edits(trees.limit(0), edits), vocabulary).count() == 0


def test_counts_query(spark, vocabulary, tmp_path):
    from marlstone.llm import queries

    texts = ["mail a@b.co or call +1 (555) 010-9999 " + "word " * 300, "plain text", None, "", "4111 1111 1111 1111" * 3, "x y a@b.co"]
    table(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    e = tokens.encoder(**vocabulary)
    n = lambda t: len(e.plain(t)) if t else 0
    got = {x["doc_id"]: x for x in queries.op4_token_counts(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        assert (got[i]["n_tokens"], got[i]["n_tokens_after"]) == (n(t), n(pii.masked(t or "")))
        assert got[i]["encoded_chars"] <= 40 + 4 * counting.LEAF_CHARS * got[i]["n_edits"]


# ------------------------------------------------------------------ 5


def repeats(texts, w):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + w] for b in raw for i in range(len(b) - w + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - w + 1):
            if seen[b[i : i + w]] > 1:
                gone[i : i + w] = True
        out.append((len(b), int(gone.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("group_rows", [4096, 2])
def test_suffix_dedup(spark, group_rows):
    r = random.Random(7)
    base = ["".join(r.choice("abcdé ") for _ in range(r.randint(0, 160))) for _ in range(20)]
    texts = []
    for _ in range(80):
        t = list("".join(r.choice(base) for _ in range(r.randint(0, 3))))
        for _ in range(r.randint(0, 2) if t else 0):
            t[r.randrange(len(t))] = "x"
        texts.append("".join(t))
    texts += [None, "", "a" * 500, "a" * 29, "ab" * 200, *texts[:5]]
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["kept_sha256"]) for x in suffix.remove_repeats(table(spark, texts), 30, 12, group_rows).collect()}
    assert [got[i] for i in range(len(texts))] == repeats(texts, 30)


def test_suffix_hot_passage(spark):
    """One passage between ever different neighbours: its group is halved until it is small or alike."""
    r = random.Random(19)
    say = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    passage = say(45)
    texts = [say(r.randint(0, 40)) + passage + say(r.randint(0, 40)) for _ in range(40)] + [passage[5:30] + say(20) for _ in range(3)] + [say(80)]
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["kept_sha256"]) for x in suffix.remove_repeats(table(spark, texts), 30, 12, 5).collect()}
    assert [got[i] for i in range(len(texts))] == repeats(texts, 30)


def test_suffix_repeated_rows(spark):
    t = "".join(random.Random(8).choice("abc") for _ in range(90))
    got = suffix.remove_repeats(table(spark, [t, t, "q" * 20], [1, 1, None]), 30, 12).collect()
    assert sorted((x["n_bytes"], x["n_removed"]) for x in got) == [(20, 0), (90, 90), (90, 90)]
    assert suffix.remove_repeats(table(spark, [])).count() == 0


def test_deep_shallow_sort():
    r = random.Random(9)
    for _ in range(40):
        n, m = r.randint(1, 50), r.choice([40, 64, 72])
        rows = np.array([[r.choice([0, 98]) if r.random() < 0.05 else 97 for _ in range(m)] for _ in range(n)], np.uint8)
        group = np.sort(np.array([r.randint(0, 2) for _ in range(n)]))
        order, lcp = suffix.deep_shallow_sort(rows, group)
        keys = [(group[i], rows[i].tobytes()) for i in order]
        assert keys == sorted(keys)
        assert all(lcp[k] == (suffix._lcp(keys[k - 1][1], keys[k][1]) if keys[k - 1][0] == keys[k][0] else -1) for k in range(1, n))


# ------------------------------------------------------------------ 6


def test_urls(spark):
    rules = [urls.split_rule(r, v) for r, v in [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block")]]
    rows = [
        ("http://A.Example.com/en/x?y", "a.example.com", "/en/x", "example.com/en/", "block"),
        ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("x://notexample.com/en/#z", "notexample.com", "/en/", "com/", "allow"),
        ("http://b.com", "b.com", "", None, "allow"),
        ("http://c.net/es/1", "c.net", "/es/1", "net/es/", "block"),
        ("http://c.net/other", "c.net", "/other", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    d = spark.createDataFrame([(i, r[0], None, "x") for i, r in enumerate(rows)], "page_id long, url string, html string, host string")
    got = sorted(tuple(r)[:5] for r in urls.judge(d, rules).collect())
    assert [g[1:] for g in got] == [r[1:] for r in rows]
    assert urls.judge(d.limit(0), rules).count() == 0


def test_url_rule_table_equals_the_expression(spark):
    r = random.Random(17)
    host = lambda: ".".join(r.choice("ab") for _ in range(r.randint(1, 4)))
    path = lambda: "".join("/" + r.choice(["", "x", "xy"]) for _ in range(r.randint(0, 3)))
    rules = [(host(), path(), r.choice(["allow", "block"])) for _ in range(60)]
    d = spark.createDataFrame([(i, f"http://{host()}{path()}", "") for i in range(200)] + [(200, None, None)], "page_id long, url string, html string")
    assert sorted(map(tuple, urls.judge(d, rules).collect())) == sorted(map(tuple, urls.judge(d, rules, inline=0).collect()))


def test_scores_are_personalised_pagerank(spark):
    """Cycles, hubs and dead ends, against the linear system."""
    from marlstone.llm import common

    r = random.Random(18)
    hosts = [f"h{i}" for i in range(40)]
    edges = {(a, b) for a in hosts[:36] for b in r.sample(hosts, r.choice([1, 2, 9])) if a != b}
    seed = {h: r.choice([0.0, 0.0, 0.4, 1.0]) for h in hosts}
    move = np.zeros((40, 40))
    for a, b in edges:
        move[hosts.index(b), hosts.index(a)] = 1 / sum(x == a for x, _ in edges)
    want = np.linalg.solve(np.eye(40) - urls.DAMPING * move, (1 - urls.DAMPING) * np.array([seed[h] for h in hosts]))
    e = spark.createDataFrame(sorted(edges), "src string, dst string")
    got = {x["host"]: x["score"] for x in urls.propagate(common.Scratch(spark, "rank"), spark.createDataFrame(list(seed.items()), "host string, seed double"), e).collect()}
    assert max(abs(got.get(h, 0.0) - w) for h, w in zip(hosts, want)) < 6 * urls.TOLERANCE
    with pytest.raises(RuntimeError):
        urls.propagate(common.Scratch(spark, "rank"), spark.createDataFrame(list(seed.items()), "host string, seed double"), e, max_rounds=3)


def test_distrust_flows_backwards(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/">' for h in hosts)
    rows = [("http://bad.net/es/", ""), ("http://friend.org/", link("bad.net")), ("http://friend.org/2", link("bad.net", "bad.net")), ("http://clean.org/", link("good.com")), ("http://mixed.org/", link("good.com", "bad.net"))]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = {r["host"]: (r["verdict"], r["distrust"]) for r in urls.judge(d, [("net", "/es/", "block")]).collect()}
    seed = 1 - urls.DAMPING
    assert got["friend.org"][1] == pytest.approx(seed * urls.DAMPING / 2)  # bad.net shares out to the two hosts that link to it
    assert got["bad.net"][0] == "block" and got["clean.org"] == ("allow", 0.0)


# ------------------------------------------------------------------ 7


def test_quality_counts(spark):
    texts = [*family(2, 30), "#a$ b%\nc\nc\n \nc d", "w1 w2 w3 w4 w5 w6 w7 w8 " * 4, "same " * 40]
    got = {r["id"]: r for r in quality.judge(table(spark, texts)).select(F.col("row.doc_id").alias("id"), "*").collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = WORD.findall(t)
        win = collections.defaultdict(list)
        for k in range(len(w) - 7):
            win[tuple(w[k : k + 8])].append(k)
        again = {k + j for v in win.values() if len(v) > 1 for k in v for j in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again))
        g = got[i]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == want
        assert g["base_failed"] == (len(w) < 20 or 100 * len(again) > 30 * len(w)) and not (g["base_failed"] and g["kept"])
    assert quality.judge(table(spark, [])).count() == 0
    assert quality.filter_quality(table(spark, texts)).columns == table(spark, texts).columns


def quality_verdicts(rows):
    """Whether the fences keep each (group, text), from exact quartiles of the rates."""

    def rate(t):
        w = WORD.findall(t)
        chars = max(1, sum(map(len, w)))
        return {"punct_rate": sum(t.count(c) for c in quality.PUNCTUATION) / chars, "word_len": chars / max(1, len(w)), "upper_rate": sum("A" <= c <= "Z" for c in t) / chars}

    found = [(g, rate(t)) for g, t in rows]
    at = lambda group, k, q: float(np.quantile([r[k] for g, r in found if group is None or g == group], q, method="inverted_cdf"))
    out, fences = [], {}
    for g, r in found:
        ok = True
        for k, side in quality.RATES.items():
            if (g, k) not in fences:
                spread = max(at(g, k, 0.75) - at(g, k, 0.25), quality.SHARE * (at(None, k, 0.75) - at(None, k, 0.25)))
                fences[g, k] = at(g, k, 0.25) - quality.FENCE * spread, at(g, k, 0.75) + quality.FENCE * spread
            lo, hi = fences[g, k]
            ok &= r[k] <= hi and (side == "high" or r[k] >= lo)
        out.append(ok)
    return out, fences


def test_quality_fences_are_each_groups_own(spark):
    """Two languages that write differently: verdicts and fences against exact quartiles."""
    r = random.Random(3)

    def prose(marks, long):
        return " ".join("".join(r.choice("abcdeA") for _ in range(r.randint(2, long))) + (r.choice("!.,") if r.random() < marks else "") for _ in range(60))

    rows = [("en", prose(0.1 + 0.05 * r.random(), 8)) for _ in range(80)] + [("de", prose(0.6 + 0.2 * r.random(), 14)) for _ in range(80)]
    rows += [("en", prose(0.8, 14)), ("de", prose(0.8, 14)), ("en", "###".join(rows[0][1].split())+" x" * 30), ("de", " ".join(w + "####" for w in rows[90][1].split()))]
    d = spark.createDataFrame([(i, t, g, "s") for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, source string")
    want, fences = quality_verdicts(rows)
    got = {x["i"]: x["kept"] for x in quality.judge(d, columns=["doc_id"]).filter("not base_failed").select(F.col("row.doc_id").alias("i"), "kept").collect()}
    assert {i: want[i] for i in got} == got and len(got) > 160
    assert got[161] and not got[163]
    for k in quality.RATES:
        assert fences["en", k] != fences["de", k]


def test_quality_group_of_copies_does_not_fence_out_the_rest(spark):
    r = random.Random(5)
    prose = lambda: " ".join("".join(r.choice("abcdeA") for _ in range(r.randint(2, 8))) + (r.choice(",.") if r.random() < 0.2 else "") for _ in range(60))
    texts = [prose()] * 300 + [prose() for _ in range(60)]
    d = spark.createDataFrame([(i, t, "en", "hot" if i < 320 else "cold") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    assert quality.judge(d, columns=["doc_id"]).filter("not kept and not base_failed").count() == 0


# ------------------------------------------------------------------ 8


def test_decontamination(spark):
    r = random.Random(4)
    vocab = ["".join(r.choice("abcdefg") for _ in range(6)) for _ in range(500)]
    say = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [say(n) for n in (40, 25, 16, 8, 3)]
    swapped = list(items[0])
    for i in (5, 11, 20, 30):
        swapped[i] = "other"
    docs = [say(50) + items[0] + say(50), say(9) + swapped + say(9), [w.upper() + "," for w in items[1]], say(30) + items[2], say(3) + items[3] + say(3), items[4] * 5, say(500), items[0][:8] + say(90)]
    d = table(spark, [" ".join(x) for x in docs] + [None, ""])
    b = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(7, None), (0, " ".join(items[0]))], "item_id long, text string")
    got = sorted((x["doc_id"], x["item_id"]) for x in decontaminate.overlaps(d, b).collect())
    assert got == [(0, 0), (1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]  # the last one is three tokens, all alike
    assert sorted(x["doc_id"] for x in decontaminate.remove(d, b).collect()) == [5, 6, 7, 8, 9]
    assert decontaminate.overlaps(d, b.limit(0)).count() == 0 and decontaminate.overlaps(d.limit(0), b).count() == 0


def test_decontamination_removes_per_row(spark):
    item = " ".join(f"w{i}" for i in range(30))
    rows = [(None, item), (None, "clean"), (None, None), (3, "x " + item), (3, "other"), (4, "fine")]
    b = spark.createDataFrame([(0, item)], "item_id long, text string")
    got = decontaminate.remove(table(spark, [t for _, t in rows], [i for i, _ in rows]).withColumns({c: F.lit(1) for c in ("bad_row", "bad_id", "region")}), b).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in got) == collections.Counter([(None, "clean"), (None, None), (3, "other"), (4, "fine")])


def test_decontamination_masks_reach_the_verdict():
    for n in range(1, decontaminate.MIN_TOKENS + 1):
        places = [sum(1 << (at + i) for i, c in enumerate(m) if c == "1") for m in decontaminate.masks(n) for at in range(n - len(m) + 1)]
        wrong = max(k for k in range(n) if n - k >= decontaminate.MIN_SHARE * n)
        for bad in itertools.combinations(range(n), wrong):
            assert any(not p & sum(1 << i for i in bad) for p in places), (n, bad)


def best_windows(doc, item):
    want, best = min(20, len(item)), 0
    for a in range(len(doc) - want + 1):
        for b in range(len(item) - want + 1):
            best = max(best, sum(x == y for x, y in zip(doc[a : a + want], item[b : b + want])))
    return best, want


def test_decontamination_brute_force(spark):
    r = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    items = [[r.choice(vocab) for _ in range(n)] for n in (*range(2, 26), 38)]
    docs = []
    for item in items:
        for share in (0.1, 0.2, 0.25):
            bad = set(r.sample(range(len(item)), int(share * len(item))))
            docs.append([r.choice(vocab) for _ in range(r.randint(0, 9))] + [r.choice(vocab) if i in bad else w for i, w in enumerate(item)] + [r.choice(vocab) for _ in range(r.randint(0, 9))])
    b = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): (x["n_same"], x["n_window"]) for x in decontaminate.overlaps(table(spark, [" ".join(x) for x in docs]), b).collect()}
    best = {(i, j): best_windows(d, item) for i, d in enumerate(docs) for j, item in enumerate(items)}
    want = {pair: (same, n) for pair, (same, n) in best.items() if same >= 0.8 * n}
    assert got == want and len(want) > 30


# ------------------------------------------------------------------ 9


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    def ok(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, t) if ok(k, m[0])]


def test_pii_base():
    r = random.Random(5)
    for _ in range(4000):
        t = "".join(r.choice(["a", "@", ".", "1", "25", "4111111111111111", "+1 (555) 010-9999", "-", " ", "_", "é", "a@b.co"]) for _ in range(r.randint(0, 14)))
        assert [s[:3] for s in pii.spans(t) if s[0] in pii.BASE_KINDS] == base_spans(t), t
    assert pii.spans("a" * 200_000 + "1" * 200_000) == []  # linear


def test_pii_context_and_checksums(spark):
    kinds = lambda t: [s[0] for s in pii.spans(t)]
    assert kinds("IBAN GB82 WEST 1234 5698 7654 32") == ["iban"] and kinds("IBAN GB83 WEST 1234 5698 7654 32") == []
    assert kinds("ssn 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert kinds("call (030) 123 4567") == ["national_phone"] and kinds("page (030) 123 4567") == []
    d = table(spark, ["x a@b.co y", None, ""])
    out = {r["doc_id"]: r["text"] for r in pii.redact(d).collect()}
    assert out == {0: "x <EMAIL> y", 1: None, 2: ""} and pii.redact(d).columns == d.columns
    assert pii.find(d.limit(0)).count() == 0


def test_pii_secrets():
    kinds = lambda t: [s[0] for s in pii.spans(t)]
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    assert kinds(f'token = "{key}" x') == ["secret"] and kinds(f'TOKEN = "{key.upper()}"!!') == ["secret"]
    assert kinds(f"commit {key}") == [] and kinds("token = aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1") == [] and kinds("password: " + "verylongwordwithoutanydigits") == []
    assert pii.masked(f'a token = "{key}".') == 'a token = "<SECRET>".'
    assert pii.spans("token " + "a1" * 200_000) == []  # linear, and too long


def test_pii_keys_and_named_values():
    got = lambda t: [(k, t[a:b]) for k, a, b, _ in pii.spans(t)]
    key = "AKIA" + "Q7" * 8
    assert got(f"x {key} y") == [("access_key", key)] and got(f"x {key}Z y") == [] and got(f"x {key.lower()} y") == []
    assert got("password=b7db7aa4a5fcc78305 end") == [("secret", "b7db7aa4a5fcc78305")]
    assert got('{"db_password": "s3cretvalue"}') == [("secret", "s3cretvalue")] and got("api-key: abc12345.") == [("secret", "abc12345")]
    assert got("see https://h/?token=abc123456&x=1") == [("secret", "abc123456")]
    # no digit, no letter, too short, no telling name
    assert got("password=changeme_now token: 12345678 secret=a1b2c3 colour=abc12345678") == []
    # a key that a telling name is given has one span, the known format's; a run that looks random likewise
    assert got(f'token = "{key}"') == [("access_key", key)]
    assert got("secret: 9f8e7d6c5b4a39281706f5e4") == [("secret", "9f8e7d6c5b4a39281706f5e4")]
    block = "-----BEGIN RSA PRIVATE KEY-----\nMIIabc\n-----END RSA PRIVATE KEY-----"
    assert got(f"a\n{block}\nb") == [("access_key", block)] and pii.masked(f"a {block} b") == "a <ACCESS_KEY> b"
    assert got("user a1@b.example password=a1@b.example") == [("email", "a1@b.example")] * 2  # base spans stay
    for long in ("=" * 300_000, "a=" * 150_000, "eyJ" * 100_000, "=a1" * 100_000, "password=" * 40_000, "-----BEGIN " * 30_000, "password=" + "a1" * 200_000):
        pii.spans(long)  # linear


def test_pii_query_digests(spark, tmp_path):
    from marlstone.llm import queries

    r = random.Random(15)
    parts = ["a@b.co", "1.2.3.4", "300.2.3.4", "4111 1111 1111 1111", "+1 (555) 010-9999", "é", "word", "token 04dbebab91ab85687d33eeaaf9ac699e1188f962", "\n", "IBAN DE89370400440532013000"]
    texts = [" ".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(80)] + [None, ""]
    table(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {x["doc_id"]: x for x in queries.op9_pii(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        base = [s for s in base_spans(t or "")]
        assert [got[i][f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert got[i]["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b, _ in pii.spans(t or ""))
        assert got[i]["n_spans"] == len(pii.spans(t or "")) == sum(got[i][f"n_{k}"] for k in pii.KINDS)


def test_pii_iban_ends_at_any_token():
    got = lambda t: [t[a:b] for k, a, b, _ in pii.spans(t) if k == "iban"]
    de, spaced, gb = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    assert got(f"IBAN {de} BIC COBADEFFXXX") == [de] and got(f"{spaced} OK") == [spaced]
    assert got(f"{gb} I paid") == [gb] and got(f"{de} 12 May") == [de]
    assert got(f"REF AB12 {spaced} {gb} X") == [spaced, gb] and got(f"NO9386011117947 {de}") == ["NO9386011117947", de]
    assert got("DE88 3704 0044 0532 0130 00 OK") == [] and got("AB12 " * 50_000) == []
    assert pii.masked(f"pay {de} BIC COBADEFFXXX now") == "pay <IBAN> BIC COBADEFFXXX now"


# ------------------------------------------------------------------ 10


def test_toxicity(spark):
    r = random.Random(6)
    vocab = ["w%d" % i for i in range(400)]
    rows, y = [], []
    for i in range(600):
        w = [r.choice(vocab) for _ in range(r.randint(5, 80))]
        toxic = int(r.random() < 0.3)
        w += [r.choice(["vile", "nasty", "awful"]) for _ in range(toxic * r.choice([1, 6]))]
        r.shuffle(w)
        rows.append(" ".join(w))
        y.append(toxic)
    d = table(spark, [*rows, None, ""])
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(y[:400])] + [(5, y[5]), (None, 1), (7, None), (9999, 1)], "doc_id long, toxic int")
    got = {x["doc_id"]: x for x in toxicity.score(d, toxicity.train(d, labels)).collect()}
    held = [got[i]["toxic"] == bool(y[i]) for i in range(400, 600)]
    assert sum(held) / len(held) >= 0.95 and len(got) == 602
    assert all(0 <= x["expected_severity"] <= 2 and x["grade"] in (0, 1, 2) for x in got.values())
    none = toxicity.score(d, toxicity.train(d, labels.limit(0)))
    assert none.filter("toxic or expected_severity <> 0").count() == 0
    assert toxicity.score(d.limit(0), toxicity.train(d, labels)).count() == 0


# ------------------------------------------------------------------ pipeline


def test_pipeline_on_fixture(spark, tmp_path):
    """Every stage's decisions against the brute-force parts above."""
    import corpus_pipeline

    r = random.Random(11)
    say = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))
    clean = [say(60) for _ in range(30)]
    item = say(30)
    near = clean[0].split(" ")
    near[59] = "edited"
    docs = [*clean, clean[1], " ".join(near), say(20) + " " + item, "too short", say(40) + " me@x.org " + say(5), None]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(docs)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted({x["doc_id"] for x in out}) == [*range(30), 34]
    e = tokens.encoder(**tokens.public_vocabulary())
    want = {i: len(e.plain(pii.masked(docs[i]))) + 1 for i in (0, 5, 34)}
    assert {i: sum(x["length"] for x in out if x["doc_id"] == i) for i in want} == want
    assert "<EMAIL>" in pii.masked(docs[34])


def test_quality_filter_equals_verdicts(spark):
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(1, words, "en", "a", 1, True), (2, None, None, None, 2, None), (3, "", "en", "a", 3, True), (4, "same " * 60, "en", "a", 4, False), (5, words, None, "a", 5, True), (5, words, None, "a", 5, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, j int, kept boolean").withColumns({c: F.lit(2) for c in ("row", "group_of", "g_lang", "t", "n_words", "hi_word_len")})
    got = quality.filter_quality(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 5, 5]
    want = quality.judge(docs).select("row.doc_id", F.col("kept").alias("k")).collect()
    assert sorted(r["doc_id"] for r in want if r["k"]) == [1, 5, 5]
