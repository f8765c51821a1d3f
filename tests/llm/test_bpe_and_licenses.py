import hashlib
import random

import pytest
from tokenizers import Tokenizer

from episoda.llm import bpe_automaton, licenses, queries, tokens
from tests.llm.helpers import SF, awkward_rows, docs_of

PATH = tokens.default_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation(), t.no_padding()
    return t


def test_automaton_accepts_only_what_merging_in_order_gives():
    """Every token sequence over a small alphabet: accepted exactly if merging its bytes, rule by rule, gives it."""
    merges = [(b"a", b"b"), (b"b", b"a"), (b"a", b"a"), (b"ab", b"b"), (b"aa", b"a"), (b"ab", b"ab"), (b"b", b"b"), (b"bb", b"bb"), (b"aa", b"aa")]
    ids = {bytes([i]): i for i in range(256)}
    for k, (x, y) in enumerate(merges):
        ids.setdefault(x + y, 256 + k)
    m = bpe_automaton.Automaton(merges, ids)
    assert len(m.copied_from) <= len(merges) + 1 and not m.has_arc(0, max(ids.values()) + 1)

    def by_rules(word):
        seq = [word[i : i + 1] for i in range(len(word))]
        for x, y in merges:
            i, out = 0, []
            while i < len(seq):
                if i + 1 < len(seq) and (seq[i], seq[i + 1]) == (x, y):
                    out.append(x + y)
                    i += 2
                else:
                    out.append(seq[i])
                    i += 1
            seq = out
        return tuple(ids[t] for t in seq)

    for n in range(1, 12):
        for bits in range(2**n):
            word = bytes(b"ab"[bits >> i & 1] for i in range(n))
            assert tuple(m.path(word)) == by_rules(word), word
    label = {i: t for t, i in ids.items()}
    live = {t: label[t] for t in m.state_of if set(label[t]) <= set(b"ab")}
    for t, x in live.items():
        for u, y in live.items():
            assert m.has_arc(m.state_of[t], u) == (by_rules(x + y) == (t, u)), (x, y)


@pytest.mark.parametrize("seed", range(12))
def test_rows_of_random_automata(seed):
    """Compiled rows against merging by the rules, over random merge lists: every pair of tokens and random words."""
    rng = random.Random(seed)
    known, merges = [b"a", b"b", b"c"], []
    while len(merges) < 40:
        x, y = rng.choice(known), rng.choice(known)
        if x + y not in known and len(x + y) < 9:
            merges.append((x, y))
            known.append(x + y)
    ids = {bytes([i]): i for i in range(256)} | {x + y: 256 + k for k, (x, y) in enumerate(merges)}
    m = bpe_automaton.Automaton(merges, ids)

    def by_rules(word):
        seq = [word[i : i + 1] for i in range(len(word))]
        for x, y in merges:
            i, out = 0, []
            while i < len(seq):
                if seq[i : i + 2] == [x, y]:
                    out.append(x + y)
                    i += 2
                else:
                    out.append(seq[i])
                    i += 1
            seq = out
        return [ids[t] for t in seq]

    for x in known:
        assert (ids[x] in m.state_of) == (by_rules(x) == [ids[x]])
    live = [x for x in known if ids[x] in m.state_of]
    for x in live:
        for y in live:
            assert m.has_arc(m.state_of[ids[x]], ids[y]) == (by_rules(x + y) == [ids[x], ids[y]]), (x, y)
    for _ in range(400):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 40)))
        assert m.path(word) == by_rules(word), word


def test_long_words_and_texts(library):
    """One word of a million bytes and a text of many: time and memory grow in proportion."""
    codec = bpe_automaton.codec(PATH)
    for text in ("ab" * 200_000, "x" * 300_001, "wordlike thing, " * 60_000, " " * 50_000 + "\n" * 50_000):
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        assert len(text) > 200_000 or ids == library.encode(text, add_special_tokens=False).ids


def test_words_are_cut_as_by_the_pattern():
    import regex

    rng, slow = random.Random(2), regex.compile(bpe_automaton.WORDS)
    some = [*map(chr, [*range(0x250), *range(0x2000, 0x2070), 0x1C5, 0x2160, 0x3007, 0x4E00, 0xAC00, 0x1680, 0x3000, 0xFFFD, 0x1D7D8, 0x1F600, 0x20000])] + ["'s", "'ll", "a", " ", "1"] * 9
    for _ in range(4000):
        t = "".join(rng.choice(some) for _ in range(rng.randint(0, 20)))
        assert bpe_automaton.cut_words(t) == slow.findall(t), ascii(t)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe_automaton.Codec(tokens.default_path("word_bpe_49k.json"))
    with pytest.raises(ValueError):
        bpe_automaton.Automaton([(b"a", b"bc"), (b"b", b"c"), (b"ab", b"c")], {bytes([i]): i for i in range(256)} | {b"bc": 256, b"abc": 257, b"ab": 258})


@pytest.mark.parametrize("seed", range(4))
def test_ids_equal_the_library(library, seed):
    rng, codec = random.Random(seed), bpe_automaton.codec(PATH)
    alphabet = ["abet ingEs'\n.,0é", "ab ", " \t\n\r\x1f\x85\xa0 x'S", "日本é😀 \U0010ffff ́a'll"][seed]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(600)]
    for t in [*texts, "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 3000, " ".join(["hello"] * 50)]:
        ids = codec.encode(t)
        assert ids == library.encode(t, add_special_tokens=False).ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False) == t
    assert codec.decode([128]) == library.decode([128], skip_special_tokens=False)


def digest(ids):
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_query_equals_the_library(spark, library):
    want = {r.doc_id: (library.encode(r.text, add_special_tokens=False).ids, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op8_bpe_automaton(spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        ids, text = want[r.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(ids), hashlib.sha256(text.encode()).hexdigest())


def test_awkward_documents(spark, library):
    rows = awkward_rows()
    got = bpe_automaton.encode_and_decode(docs_of(spark, rows)).collect()
    assert sorted((str(r.doc_id), tuple(r.ids), r.decoded) for r in got) == sorted((str(r[0]), tuple(library.encode(r[1] or "", add_special_tokens=False).ids), r[1] or "") for r in rows)
    assert bpe_automaton.encode_and_decode(docs_of(spark, [])).count() == 0


def slow_scan(rows, threshold=licenses.THRESHOLD):
    """Every segment against every template, without size bounds."""
    known, out = licenses.template_bigrams(), []
    for doc, text in rows:
        t = text or ""
        parts = [("line", i, x) for i, x in enumerate(t.split("\n"))] + [("paragraph", i, x) for i, x in enumerate(t.split("\n\n")) if "\n" in x] + ([("whole", 0, t)] if "\n\n" in t else [])
        for kind, place, body in parts:
            w = licenses.normalised(body).split(" ")
            grams = {f"{a} {b}" for a, b in zip(w, w[1:])}
            best = max(((round(2 * len(grams & set(g)) / (len(grams) + len(g)), 6), [-ord(c) for c in name], name) for name, g in known), default=None) if grams else None
            if best and best[0] >= threshold:
                out.append((str(doc), kind, place, best[2], best[0], len(grams)))
    return sorted(out)


def test_scan_against_brute_force(spark):
    mit, gpl = (t for n, t in licenses.TEMPLATES if (n, t[:8]) in (("mit", "Permissi"), ("gpl-3.0", "This pro")))
    rows = [(1, "text\nReleased under the MIT License!\nmore"), (2, mit.upper()), (3, mit.replace(" ", "\n", 30) + "\n\nother paragraph\nof lines"), (4, gpl[:120]), (5, gpl.replace("redistribute", "copy")), (6, None), (7, ""), (8, "\n\n\n"), (9, "All rights reserved"), (9, "All rights reserved"), (None, "all all rights rights reserved reserved"), (10, "licensed under cc by 4 0"), (11, " ".join(["rights"] * 5000))]
    rows += [(100 + r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [(5000 + i, r[1]) for i, r in enumerate(awkward_rows())]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, license string")
    got = sorted((str(r.doc_id), r.kind, r.place, r.license, r.dice, r.bigrams) for r in licenses.scan(docs).collect())
    assert got == slow_scan(rows) and len(got) > 8
    assert licenses.scan(docs.limit(0)).count() == 0


def test_scan_is_native(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Join", "Exchange"))


def test_scan_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = queries.op9_license_scan(spark, SF)
    want = con.execute(queries.ORACLE_SQL["op9_license_scan"]).df()
    assert sorted(want.columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*want.columns).collect())) == sorted(want.itertuples(index=False, name=None))


def allocated(spark):
    """Bytes that each task thread has allocated so far."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getThreadMXBean()
    ids = [t for t in beans.getAllThreadIds() if (x := beans.getThreadInfo(t)) and "Executor task" in x.getThreadName()]
    return {t: beans.getThreadAllocatedBytes(t) for t in ids}


def test_scan_allocates_in_proportion(spark):
    """A string for every word pair of every segment took 300 bytes a byte of text and let an executor's heap grow to its limit."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").crossJoin(spark.range(40)).select("doc_id", "text").repartition(8).cache()
    size = docs.selectExpr("sum(octet_length(text))").first()[0]
    assert licenses.scan(docs).count() == 40 * queries.op9_license_scan(spark, SF).count() > 0  # and the code is compiled
    before = allocated(spark)
    licenses.scan(docs).count()
    used = sum(n - before.get(t, 0) for t, n in allocated(spark).items())
    docs.unpersist()
    assert size > 5e6 and 0 < used < 160 * size, used / size


def test_scan_at_the_bounds(spark):
    """Segments just in and just out of reach: words left out, put in, repeated and cut by lines, at several thresholds."""
    rng, rows = random.Random(9), []
    for _, t in licenses.TEMPLATES:
        for _ in range(25):
            w = t.split(" ")
            for _ in range(rng.randint(0, 1 + len(w) // 4)):
                i = rng.randrange(len(w))
                w[i : i + rng.randint(0, 1)] = rng.choice(([], ["the"], ["License"], ["\u03a3\u03a3"], ["--"], [w[i], w[i]]))
            body = "".join(x + rng.choice((" ", " ", " ", " ", "  ", "\n", " \n ", "\n\n", ", ", "\t", "\r\n")) for x in w)
            rows.append((len(rows), rng.choice(("", "\n", "\n\n\n", "Some of the words.\n\n")) + body + rng.choice(("", "\n", "\n\n\nof the\n"))))
        rows += [(len(rows) + k, x) for k, x in enumerate((" ".join([t] * 40), "\n\n".join([t] * 40), t + " rights" * 900, " ".join(map(str, range(900))) + "\n" + t))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (0.3, 0.8, 1.0):
        got = sorted((str(r.doc_id), r.kind, r.place, r.license, r.dice, r.bigrams) for r in licenses.scan(docs, threshold).collect())
        assert got == slow_scan(rows, threshold) and len(got) > 50
