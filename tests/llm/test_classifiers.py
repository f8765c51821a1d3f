import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from episoda.llm import quality, queries, toxicity
from tests.llm.helpers import SF, awkward_rows, docs_of


def held_out(doc_id, mod, rest):
    return zlib.crc32(str(doc_id).encode()) % mod == rest


def corpus(n, make, seed=1):
    rng = random.Random(seed)
    return [(i, *make(rng, i)) for i in range(n)]


def good_or_bad(rng, i):
    words = [rng.choice(["river", "stone", "window", "garden", "letter", "winter", "morning", "table"]) for _ in range(rng.randint(30, 300))]
    return (" ".join(words), 1) if i % 4 else (" ".join(w + rng.choice(["$$$", "%%%", "###"]) for w in words), 0)


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y, y) for i, _, y in rows], "doc_id long, quality int, toxic int")


def test_network_gradients_are_right(monkeypatch):
    rng = np.random.default_rng(0)
    net = quality.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    monkeypatch.setattr(quality, "_TRAINED", 4)  # several windows of chunks, one of which ends within a text
    raws, y = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (500, 0, 300, 470, 130)], np.array([0, 1, 1, 0, 1.0])
    chunks, fill, starts = quality._batch(raws)
    assert len(chunks) == 3 + 1 + 2 + 3 + 1
    loss, g = net.gradients(chunks, fill, starts, y)
    slow = np.array([slow_quality(net, r) for r in raws])
    assert loss == pytest.approx(-(y * np.log(slow) + (1 - y) * np.log(1 - slow)).mean(), abs=1e-6)
    for k, v in net.p.items():
        for at in rng.choice(v.size, min(4, v.size), replace=False):
            place = np.unravel_index(int(at), v.shape)
            was = v[place]
            ends = []
            for d in (1e-5, -1e-5):
                v[place] = was + d
                ends.append(net.gradients(chunks, fill, starts, y)[0])
            v[place] = was
            assert g[k][place] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=2e-4, rel=2e-2)


def slow_quality(net, raw):
    """The forward pass as it is defined, chunk by chunk and filter place by filter place, in double precision."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    n = max(2, -(-len(raw) // quality.HOP))
    padded = raw + b"\0" * (n * quality.HOP - len(raw))
    out = []
    for s in range(0, (n - 1) * quality.HOP, quality.HOP):
        chunk = padded[s : s + quality.CHUNK]
        best = np.full(quality.FILTERS, -np.inf)
        for at in range(0, quality.CHUNK - 2 * quality.STRIDE + 1, quality.STRIDE):
            left, right = (np.concatenate([p["embed"][b] for b in chunk[k : k + quality.STRIDE]]) for k in (at, at + quality.STRIDE))
            best = np.maximum(best, left @ p["left"] + right @ p["right"] + p["shift"])
        x = np.append(np.maximum(best, 0), min(1, max(0, (len(raw) - s) / quality.CHUNK)))
        out.append(np.maximum(x @ p["dense"] + p["bias"], 0))
    doc = np.concatenate([np.max(out, 0), np.mean(out, 0)])
    return 1 / (1 + np.exp(-(doc @ p["out"] + p["level"][0])))


def test_scores_equal_a_slow_forward_pass(monkeypatch):
    rng = np.random.default_rng(2)
    raws = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 127, 128, 129, 255, 256, 257, 383, 384, 385, 3000, 5000)]
    net = quality.Network(4)
    want = [slow_quality(net, r) for r in raws]
    assert net.score(raws) == pytest.approx(want, abs=1e-5)
    monkeypatch.setattr(quality, "_WINDOW", 3)  # long texts in windows of three chunks
    assert net.score(raws) == pytest.approx(want, abs=1e-5)


def test_memory_of_a_very_long_text_is_bounded():
    import tracemalloc

    net, raw = quality.Network(1), b"some words of a long text, " * 2_000_000  # 54 MB
    tracemalloc.start()
    one = net.score([raw])[0]
    assert tracemalloc.get_traced_memory()[1] < 150 << 20 and 0 < one < 1
    tracemalloc.stop()
    assert abs(one - net.score([raw[: 27 * 128 * 400]])[0]) < 0.05  # the same chunks again and again


def test_score_reads_the_whole_document():
    net = quality.Network(1)
    body = bytes(np.random.default_rng(0).integers(97, 123, 5000, dtype=np.uint8))
    base = net.score([body])[0]
    assert any(abs(net.score([body[:at] + b"\xff\xfe" * 40 + body[at + 80 :]])[0] - base) > 1e-9 for at in (4800,))
    assert all(abs(net.score([body[:at] + b"\xff\xfe" * 60 + body[at + 120 :]])[0] - base) > 1e-9 for at in range(0, 4800, 600))
    alone = [net.score([t])[0] for t in (b"", b"a", body, body[:300])]
    assert net.score([b"", b"a", body, body[:300]]) == pytest.approx(alone, abs=1e-6)


def test_quality_learns_and_filters(spark):
    rows = corpus(500, good_or_bad)
    docs, labels = frames(spark, rows)
    net = quality.fit(docs, labels)
    got = {r.doc_id: r.quality_score for r in quality.score(docs, net).collect()}
    unseen = [(i, y) for i, _, y in rows if held_out(i, 5, 0)]
    assert np.mean([(got[i] >= 0.3) == y for i, y in unseen]) > 0.97
    assert quality.fit(docs, labels).p["out"] == pytest.approx(net.p["out"])  # the same sample gives the same network


def test_training_reads_whole_texts_within_its_bounds(spark):
    """What tells good from bad stands behind the first 20 KB; rows beyond the bytes are passed over, shorter ones after them are not."""
    rng = random.Random(3)
    head = lambda: " ".join(rng.choice(["river", "stone", "window", "garden"]) for _ in range(3400))
    rows = [(i, head() + (" and so on" if i % 2 else " $$$ %%% ###") * 40, i % 2) for i in range(60)]
    docs, labels = frames(spark, rows)
    net = quality.fit(docs, labels)
    assert np.mean([(net.score([t.encode()])[0] >= 0.5) == y for i, t, y in rows if held_out(i, 5, 0)]) > 0.9
    from collections import namedtuple

    row = namedtuple("row", "doc_id place bytes")
    assert quality._fitting([row(1, 9, 5), row(2, -4, 6), row(3, 0, 50), row(4, 2, 4), row(5, 2, 0)], 12) == [(2,), (4,), (5,)]
    assert quality.fit(docs, labels, sample_bytes=10) is None and quality.fit(docs, labels, sample=1) is None


def test_classifiers_never_look_at_held_out_labels(spark):
    rows = corpus(200, good_or_bad)
    docs, labels = frames(spark, rows)
    flip = lambda mod, rest: labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest, 1 - F.col("quality")).otherwise(F.col("quality"))).withColumn("toxic", F.col("quality"))
    a, b = quality.fit(docs, labels), quality.fit(docs, flip(5, 0))
    assert all((a.p[k] == b.p[k]).all() for k in a.p)
    c, d = toxicity.fit(docs, labels), toxicity.fit(docs, flip(3, 1))
    assert (c.features, c.weights, c.level) == (d.features, d.weights, d.level)


def test_awkward_documents_and_missing_labels(spark):
    docs = docs_of(spark, awkward_rows())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.quality_score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert {r.toxic_score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    kept = quality.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(20)] + [(None, 1, 1), (3, None, None), (4, 7, 9)], "doc_id long, quality int, toxic int")
    for scored, column in ((quality.score(docs, quality.fit(docs, labels)), "quality_score"), (toxicity.score(docs, toxicity.fit(docs, labels)), "toxic_score")):
        assert scored.where(f"{column} BETWEEN 0 AND 1").count() == docs.count() == scored.count()
    empty = docs_of(spark, [])
    assert quality.keep_good(empty, labels).count() == 0 and toxicity.keep_clean(empty, labels).count() == 0


def test_columns_that_clash_and_labels_that_contradict(spark):
    rows = corpus(120, good_or_bad)
    docs = spark.createDataFrame([(i, t, 7.0, 8.0, "mine") for i, t, _ in rows], "doc_id long, text string, quality_score double, TOXIC_SCORE double, _own_score string")
    labels = spark.createDataFrame([(i, y, 1 - y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    for kept in (quality.keep_good(docs, labels), toxicity.keep_clean(docs, labels)):
        assert kept.columns == docs.columns
        found = kept.collect()
        assert 0 < len(found) <= 120 and {(r[2], r[3], r[4]) for r in found} == {(7.0, 8.0, "mine")}
    assert quality.score(docs, None).where("quality_score <> 0.5").count() == 0
    from episoda.llm import common

    many = spark.createDataFrame([(1, f"t{k}") for k in range(500)] + [(2, None), (3, "x"), (4, "y")], "doc_id long, text string")
    said = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (3, 1), (4, 2)], "doc_id long, quality int")
    got = [tuple(r) for r in common.labelled_sample(many, said, "quality", F.lit(False), 9).collect()]
    assert sorted(got) == [(1, 1, "t0"), (2, 0, "")] and common.labelled_sample(many, said, "quality", F.lit(False), 1).count() == 1


def slur(rng, i):
    base = [rng.choice(["people", "said", "house", "market", "music", "evening", "family", "travel", "coffee"]) for _ in range(40)]
    toxic = i % 3 == 0
    if toxic:
        base[rng.randrange(40)] = "vexo" + rng.choice(["ra", "lin", "tum", "dor", "sel", "mak"])
    return " ".join(base[:20]) + ". " + " ".join(base[20:]) + ".", int(toxic)


def test_toxicity_generalises_to_unseen_forms(spark):
    rows = corpus(600, slur)
    docs, labels = frames(spark, rows)
    model = toxicity.fit(docs, labels)
    assert np.mean([(model.score(t) >= 0.7) == y for i, t, y in rows if held_out(i, 3, 1)]) > 0.97
    assert model.score("market music vexobly evening") >= 0.7 and model.score("") < 0.3


def test_counterfactual_penalty_spares_neutral_mentions(spark):
    """Toxic sentences of this sample mostly name one group; swapping the group must not change the score."""

    def make(rng, i):
        text, y = slur(rng, i)
        group = rng.choice(["muslims"] * 8 + ["christians"]) if y else rng.choice(["christians", "hindus", "jews", "muslims"] + [""] * 12)
        return text.replace(". ", f" {group}. ", 1), y

    rows = corpus(600, make)
    docs, labels = frames(spark, rows)
    plain, fair = (toxicity.fit(docs, labels, counterfactual=c) for c in (0.0, 5.0))
    neutral = [f"the {g} family travel in the evening" for g in ("muslims", "christians", "hindus")]
    gap = lambda m: max(map(m.score, neutral)) - min(map(m.score, neutral))
    logit = lambda m: {m.features[k]: w for k, w in enumerate(m.weights)}.get("=muslims", 0.0)
    assert abs(logit(fair)) < 0.25 * abs(logit(plain)) and gap(fair) < gap(plain)
    assert np.mean([(fair.score(t) >= 0.7) == y for i, t, y in rows if held_out(i, 3, 1)]) > 0.95


def slow_objective(rows, pairs, w, level, ridge, counterfactual):
    toxic = sum(y for y, _ in rows)
    loss = ridge / 2 * sum(x * x for x in w)
    for y, present in rows:
        q = 1 / (1 + np.exp(-(level + sum(w[k] for k in present))))
        loss -= 0.25 / toxic * np.log(q) if y else 0.75 / (len(rows) - toxic) * np.log(1 - q)
    total = sum(n for *_, n in pairs)
    return loss + counterfactual * sum(n * (sum(w[k] for k in a) - sum(w[k] for k in b)) ** 2 for a, b, n in pairs) / total


def test_objective_and_gradient_against_a_slow_version():
    rng = np.random.default_rng(5)
    some = lambda: np.flatnonzero(rng.random(9) < 0.4)
    rows, pairs = [(int(k % 3 == 0), some()) for k in range(30)], [(some(), some(), int(rng.integers(1, 9))) for _ in range(12)]
    own = toxicity.Objective(rows, pairs, 9, 1e-3, 2.0)
    slow = lambda x: slow_objective(rows, pairs, x[:-1], x[-1], 1e-3, 2.0)
    at = rng.standard_normal(10)
    loss, g = own(at[:-1], at[-1])
    assert loss == pytest.approx(slow(at))
    for k in range(10):
        step = np.eye(10)[k] * 1e-5
        assert g[k] == pytest.approx((slow(at + step) - slow(at - step)) / 2e-5, abs=1e-6)
    w, level = toxicity.train(own)
    best = slow(np.append(w, level))
    assert all(best < slow(np.append(w, level) + rng.standard_normal(10) * s) for s in (0.1, 0.3, 1.0) for _ in range(20))
    assert np.abs(own(w, level)[1]).max() < 5e-3


def test_scores_equal_a_slow_sum():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    features = sorted({f for w in words[:30] for f in toxicity.features_of(w)})[::2]
    model = toxicity.Model(features, [rng.uniform(-1, 1) for _ in features], 0.3)
    for _ in range(50):
        text = rng.choice(" \n.1_").join(rng.choice(words).upper() for _ in range(rng.randint(0, 30)))
        held = {f for w in toxicity.words(text) for f in toxicity.features_of(w)}
        z = 0.3 + sum(w for f, w in zip(model.features, model.weights) if f in held)
        assert model.score(text) == pytest.approx(1 / (1 + np.exp(-z)))


def test_pairs_are_what_swapping_changes():
    """Every pair against the features of the sentence before and after; sentences without a term get one first."""
    features = sorted({f for kind in toxicity.IDENTITY_TERMS for t in kind for f in toxicity.features_of(t)} | {"=house", "hous"})[::3]
    matcher = toxicity.Matcher(features)
    alone = {t: matcher.find([t]) for kind in toxicity.IDENTITY_TERMS for t in kind}
    for text in ("The women and the old men came. A house stood there!", "blind womens house of muslims\nmuslim", "1 2 3", ""):
        want = []
        for sentence in toxicity._SENTENCE.findall(text):
            ws = toxicity.words(sentence)
            if ws and not set(ws) & set(alone):
                ws = [*ws, toxicity.mention(ws)]
            for a, b in toxicity.swaps(ws if set(ws) & set(alone) else []):
                if {a} <= {w for w in ws} and (len([w for w in ws if w in alone]) == 1 or a in toxicity.words(sentence)):
                    before, after = matcher.find(ws), matcher.find([b if w == a else w for w in ws])
                    want.append((tuple(sorted(after - before)), tuple(sorted(before - after))))
        assert list(toxicity.pairs_of(text, matcher, alone)) == [p for p in want if p != ((), ())]


def test_the_penalty_acts_on_the_supplied_table(spark):
    """The supplied texts name no group, so mentions are put in; the fitted weights differ from those without the penalty."""
    from episoda.llm import common

    sf = SF.replace("0.001", "0.01")
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    fair, plain = (toxicity.fit(docs, labels, counterfactual=c) for c in (1.0, 0.0))
    assert fair.features == plain.features and max(abs(a - b) for a, b in zip(fair.weights, plain.weights)) > 1e-3
    terms = [t for kind in toxicity.IDENTITY_TERMS for t in kind]
    spread = lambda m: np.std([m.score(t) for t in terms])
    assert spread(fair) <= spread(plain)


def test_swaps_stay_within_their_kind():
    assert ("muslims", "christians") in set(toxicity.swaps(["the", "muslims"], 99)) and not list(toxicity.swaps(["the", "table"]))
    assert all(any(a in k and b in k for k in toxicity.IDENTITY_TERMS) for a, b in toxicity.swaps(["women", "black"]))


@pytest.mark.parametrize(("name", "label", "floor"), [("op4_quality_classifier", "quality", 0.9), ("op10_toxicity", "toxic", 0.85)])
def test_held_out_accuracy_of_the_queries(spark, name, label, floor):
    sf = SF.replace("0.001", "0.01")
    mod, rest, cut = (5, 0, 0.3) if label == "quality" else (3, 1, 0.7)
    got = queries.QUERIES[name](spark, sf).collect()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == 1000
    for r in got:
        assert r.held_out == held_out(r.doc_id, mod, rest) and 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
    own = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in own]) >= floor
