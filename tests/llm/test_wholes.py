"""Mixing, packing, top-k, the language model and the pipeline."""

import functools
import math
import pathlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests_llm_helpers import corpus, frame, ready  # noqa: F401
from titlepulse.llm import katz_lm, mixing, packing, topk
from titlepulse.llm.common import components
from titlepulse.sources.shared import SHUFFLE_CLEANUP


def plain_slots(parts, need):
    """Earliest deadline first, slot after slot from the first: {(source, block): slot}."""
    whole, done, out = sum(parts), [0] * len(parts), {}
    for t in range(min(whole, max(-(-n * whole // p) for p, n in zip(parts, need)))):
        i = min((-(-(done[i] + 1) * whole // p), i) for i, p in enumerate(parts) if done[i] * whole // p <= t)[1]
        out[i, done[i]] = t
        done[i] += 1
    return {(i, j): t for (i, j), t in out.items() if j < need[i]}


@pytest.mark.parametrize("seed", range(6))
def test_spans_of_slots_meet_in_one_schedule(spark, seed):
    rng = random.Random(seed)
    parts = [rng.choice([rng.randint(1, 9), rng.randint(1, 400), 50]) for _ in range(rng.randint(2, 7))]
    need = [rng.randint(1, p) for p in parts]
    frame = spark.createDataFrame([(f"={n:03}", p, k) for n, (p, k) in enumerate(zip(parts, need))], "_key string, parts long, need long")
    found = mixing.block_slots(frame, span=8, fold=4).collect()
    assert len(found) == sum(need) and {(r.i, r.j): r.t for r in found} == plain_slots(parts, need)


@pytest.mark.parametrize("weights", [{"a": 0.0001, "b": 0.9999}, {"a": math.sqrt(2), "b": math.pi, "c": 1, "d": math.sqrt(3) / 10}, {"a": 3, "b": 1}])
def test_mixing_holds_the_given_weights(spark, weights):
    from fractions import Fraction

    parts = mixing.whole_parts(weights)
    exact = {s: Fraction(str(w)) / sum(Fraction(str(w)) for w in weights.values()) for s, w in weights.items()}
    count = 12_000
    frame = spark.createDataFrame([(f"={s}", p, min(p, count)) for s, p in parts.items()], "_key string, parts long, need long")
    slots = {(r.i, r.j): r.t for r in mixing.block_slots(frame).collect()}
    whole, names = sum(parts.values()), sorted(weights)
    taken = {}
    for i, source in enumerate(names):
        for j in range(count):
            t = j // parts[source] * whole + slots[i, j % parts[source]]
            if t < count:
                taken[t] = source
    got = Counter()
    for t in range(count):
        got[taken[t]] += 1
        assert all(abs(got[s] - w * (t + 1)) < 1 for s, w in exact.items())


def test_mixing_deviates_by_less_than_a_block(frame):
    sizes = {"a": 400, "b": 90, None: 60, "": 30}
    rows = [(n * 10 + k, "t", s) for k, (s, c) in enumerate(sizes.items()) for n in range(c)]
    found = mixing.mix(frame(rows), block_docs=4).collect()
    assert Counter((r.doc_id, r.source) for r in found) == Counter((i, s) for i, _, s in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r._slot].append(r)
        assert r._release <= r._slot < r._due
    assert all(len({r.source for r in own}) == 1 and sorted(r._offset for r in own) == list(range(len(own))) for own in slots.values())
    weights = {s: math.floor(math.sqrt(c) * 1000) for s, c in sizes.items()}
    last = {s: max(r._slot for r in found if r.source == s) for s in sizes}
    got = Counter()
    for slot in range(min(last.values())):
        got[slots[slot][0].source] += 1
        for source, weight in weights.items():
            assert abs(got[source] * sum(weights.values()) - (slot + 1) * weight) < sum(weights.values())


def test_mixing_to_given_weights_and_edges(frame):
    rows = [(n, None, "ab"[n % 2]) for n in range(40)] + [(7, None, "b"), (7, None, "b"), (None, None, "a"), (9, "x", "c")]
    found = mixing.mix(frame(rows), {"a": 3, "b": 1, "c": 0}, block_docs=1).collect()
    assert sorted(r.source for r in found) == ["a"] * 21 + ["b"] * 22
    order = [r.source for r in sorted(found, key=lambda r: r._slot)][:16]
    assert Counter(order) == {"a": 12, "b": 4} and len({r._slot for r in found}) == len(found)
    assert all(r._release <= r._slot < r._due for r in found)
    assert mixing.mix(frame([])).collect() == []
    assert [r.doc_id for r in mixing.in_mixed_order(frame(rows), weights={"c": 1}).collect()] == [9]
    assert mixing.mix(frame(rows), {"z": 1}).collect() == []
    with pytest.raises(ValueError):
        mixing.whole_parts({"a": -1})


def test_mixing_orders_equal_hashes_within_a_source(frame):
    """Rows with equal ids have equal hashes: they take neighbouring places, each its own."""
    rows = [(5, f"t{n}", "a") for n in range(10)] + [(n, "u", "a") for n in range(100, 105)]
    found = sorted(mixing.mix(frame(rows), block_docs=3).collect(), key=lambda r: (r._slot, r._offset))
    places = [n for n, r in enumerate(found) if r.doc_id == 5]
    assert len(found) == 15 and places == list(range(places[0], places[0] + 10)) and {r.text for r in found} == {t for _, t, _ in rows}


def test_histogram_packing():
    rng = random.Random(4)
    counts = Counter(rng.choice([rng.randint(1, 100), rng.randint(1, 20), 100]) for _ in range(5000))
    patterns = packing.pack_histogram(counts, 100)
    placed = Counter()
    for lengths, packs in patterns:
        assert sum(lengths) <= 100 and packs > 0
        for n in lengths:
            placed[n] += packs
    assert placed == counts
    padding = sum((100 - sum(lengths)) * packs for lengths, packs in patterns)
    assert padding < 0.02 * sum(k * n for k, n in counts.items())
    assert packing.pack_histogram({}, 100) == [] and packing.pack_histogram({60: 3}, 100) == [((60,), 1)] * 3 or packing.pack_histogram({60: 3}, 100) == [((60,), 3)]


def check_packing(found, rows, width):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.tokenizer_path())
    own.encode_special_tokens = True
    pieces = defaultdict(list)
    for r in found:
        pieces[(r.doc_id, r.doc_tokens)].append(r)
    expected = Counter()
    for doc_id, text in rows:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), width):
            part = ids[start : start + width]
            expected[(doc_id, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append(r)
    for own_ in sequences.values():
        at = 0
        for r in sorted(own_, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= width
    return sequences


def test_packing_is_an_exact_round_trip(frame):
    rows = corpus(9) + [(900, "<|endoftext|> don't  stop\n\n 123 Ünï日本 x" * 3)]
    found = packing.pack(frame(rows), width=64).collect()
    sequences = check_packing(found, rows, 64)
    assert len(sequences) <= 1.02 * sum(r.length for r in found) / 64 + 1
    assert packing.pack(frame([])).collect() == []


def test_added_tokens_have_the_ids_of_the_unmodified_tokenizer(frame, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer
    from titlepulse.llm.queries import QUERIES

    own = Tokenizer.from_file(packing.tokenizer_path())
    assert own.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n\n  y", "<|endoftext|", "plain don't 日本", None, ""]
    docs = frame(list(enumerate(texts)), clash=False)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    expected = {}
    for n, text in enumerate(texts):
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 1]
        expected[n] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    for found in (QUERIES["op7_packing"](docs.sparkSession, str(tmp_path)), corpus_pipeline.packing_stage(docs.sparkSession, docs, str(tmp_path))):
        assert {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in found.collect()} == expected


@pytest.mark.parametrize("scale", [1, 1e6])
def test_topk_equals_brute_force(spark, scale):
    rng = np.random.default_rng(5)
    rows = [(n, (scale * rng.normal(size=8)).round(3).tolist()) for n in range(300)]
    rows += [(300 + n, rows[n][1]) for n in range(40)] + [(7, rows[9][1]), (50, rows[50][1])]
    rows += [(1000, None), (1050, [1.0, None] * 4), (1100, [float("nan")] * 8), (1150, [math.inf] * 8), (None, rows[0][1]), (1200, [1.0, 2.0]), (1201, [0.5, 0.5]), (1250, [])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, rank int, score int")
    found = topk.top_k(frame, shard_rows=64, query_rows=3).collect()
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for q, a in [(i, v) for i, v in use if i % 50 == 0]:
        all_ = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in use if i != q and len(b) == len(a))
        expected += [(q, rank, i, -score) for rank, (score, i) in enumerate(all_[:5], 1)]
    assert sum(q == 50 for q, *_ in expected) == 10  # its id is there twice, with a list for each row
    assert sorted(map(tuple, found)) == sorted(expected)


def test_topk_of_an_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def plain_katz(rows, order):
    """Scores by recursion over every n-gram, and for each held-out context met the sum of its probabilities."""
    tokens = lambda t: [*(w.encode().lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")), b""]
    grams = lambda x: [tuple(["^"] * (order - 1) + x)[n : n + order] for n in range(len(x))]
    training = [tokens(t) for i, t in rows if not katz_lm.held_out(i)]
    count = [Counter(g[order - k :] for x in training for g in grams(x)) for k in range(order + 1)]
    after = defaultdict(list)
    for k in range(2, order + 1):
        for g in count[k]:
            after[g[:-1]].append(g)
    factors = [katz_lm.discounts(Counter(c.values())) for c in count]
    spare = max(1, sum(n == 1 for n in count[1].values()))
    whole = sum(count[1].values()) + spare

    @functools.cache
    def sizes(h):
        k = len(h) + 1
        mass = sum(count[k][g] * (factors[k][count[k][g]] if count[k][g] <= katz_lm.DISCOUNTED else 1) for g in after[h])
        size = sum(count[k][g] for g in after[h])
        size += mass > size * (1 - 1e-9)
        return size, (1 - mass / size) / (1 - sum(p(g[1:]) for g in after[h]))

    @functools.cache
    def p(g):
        n = count[len(g)][g]
        if len(g) == 1:
            return (n or spare) / whole
        if n:
            return n * (factors[len(g)][n] if n <= katz_lm.DISCOUNTED else 1) / sizes(g[:-1])[0]
        return p(g[1:]) * (sizes(g[:-1])[1] if g[:-1] in after else 1)

    for h in [h for h in list(after) if len(h) == order - 1][:20]:
        assert abs(sum(p((*h, w)) for (w,) in count[1]) + p((*h, "never")) - 1) < 1e-9
    out = []
    for i, t in rows:
        seen, total = [count[1][(w,)] for w in tokens(t)], whole - spare
        base = sum(math.log10((n + 1) / (total + len(count[1]) + 1)) for n in seen)
        out.append((i, katz_lm.held_out(i), len(seen), sum(n > 0 for n in seen), total, base, sum(map(math.log10, map(p, grams(tokens(t)))))))
    return out


@pytest.mark.parametrize(
    "options, order",
    [({}, 3), ({"order": 2}, 2), ({"order": 4, "block_tokens": 300}, 4), ({"hot_tokens": 2, "block_tokens": 50}, 3), ({"order": 2, "hot_tokens": 5, "block_tokens": 1}, 2)],
)
def test_language_model_equals_recursion_over_every_ngram(frame, options, order):
    rows = corpus(11, docs=40)
    found = katz_lm.score(frame(rows).repartition(3), **options).collect()
    key = lambda r: (str(r[0]), r[2], round(r[-1], 6))
    for mine, other in zip(sorted(map(tuple, found), key=key), sorted(plain_katz(rows, order), key=key), strict=True):
        assert mine[:5] == other[:5]
        assert mine[5] == pytest.approx(other[5], rel=1e-9) and mine[6] == pytest.approx(other[6], rel=1e-9)


def test_language_model_edges(frame):
    assert katz_lm.score(frame([])).collect() == []
    held = next(i for i in range(100) if katz_lm.held_out(i))
    (row,) = katz_lm.score(frame([(held, "only held out")])).collect()
    assert (row.train_tokens, row.n_known, row.n_tokens) == (0, 0, 4) and row.score <= 0


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5), (2, 1)]
    found = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    assert found == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20}
    path = spark.createDataFrame([(n, n + 1) for n in range(200)], "a long, b long")
    assert {r.component_id for r in components(path, "t").collect()} == {0}
    assert components(spark.createDataFrame([], "a long, b long"), "t").collect() == []


def test_katz_leaves_no_shuffle_files_of_finished_lengths(spark, frame):
    def shuffle_files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {path.name for folder in disk.localDirsString() for path in pathlib.Path(folder).glob("*/shuffle_*")}

    before, setting = shuffle_files(), spark.conf.get(SHUFFLE_CLEANUP)
    scored = katz_lm.score(frame(corpus(3)).repartition(3), block_tokens=500)
    until = time.monotonic() + 20  # the files are deleted in the background
    while shuffle_files() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffle_files() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert scored.count() == len(corpus(3))


def test_pipeline_equals_its_stages_done_plainly(spark, frame, tmp_path):
    import corpus_pipeline
    from test_repeats import plain_groups
    from titlepulse.llm import pii, quality_rules

    rng = random.Random(3)
    rows = corpus(13) + [(700 + n, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 99)) for _ in range(40)) + f" write to u{n}@example.com") for n in range(12)]
    docs = frame(rows, clash=False)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    passed = quality_rules.judge(docs).where("judged.kept").select("doc_id", "text").collect()
    left = [(r.doc_id, r.text) for r in passed]
    assert set(left) < set(rows) and len(left) > 20
    group = {i: c for i, _, c in plain_groups(left)}
    kept = [(i, pii.redacted(t)) for i, t in left if i is None or group[i] == i]
    check_packing(found, kept, packing.WIDTH)
    assert any("[EMAIL]" in t for _, t in kept)
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, str(tmp_path)).columns == docs.columns, name
    assert len(names) == 5


def test_packing_follows_the_mix(spark, frame, monkeypatch):
    import corpus_pipeline

    rows = [(n, f"word{n} " * (n % 7 + 1), "abc"[n % 3]) for n in range(240)]
    docs = frame(rows, clash=False)
    monkeypatch.setattr(corpus_pipeline, "WINDOWS", {"window_slots": 4, "window_docs": 12})
    packed = {}
    for weights in ({"a": 1, "b": 1, "c": 1}, {"a": 6, "b": 1, "c": 1}, {"a": 1, "b": 1}):
        monkeypatch.setattr(corpus_pipeline, "MIX", {"weights": weights, "block_docs": 2})
        mixed = corpus_pipeline.mixing_stage(spark, docs, "")
        slots = {r.doc_id: r._slot for r in mixing.mix(docs, **corpus_pipeline.MIX).collect()}
        assert {r.doc_id for r in mixed.collect()} == set(slots)
        found = corpus_pipeline.packing_stage(spark, mixed, "").collect()
        sequences = check_packing(found, [(i, t) for i, t, s in rows if s in weights], packing.WIDTH)
        assert sorted(sequences) == list(range(len(sequences)))
        # Sequences go through the slots in order: none begins before the last slot of the one before its window.
        spans = [(min(slots[r.doc_id] for r in own), max(slots[r.doc_id] for r in own)) for _, own in sorted(sequences.items())]
        assert len(spans) > 5 and all(a[1] < b[0] or a[0] // 4 == b[0] // 4 for a, b in zip(spans, spans[1:]))
        packed[tuple(weights.items())] = {(r.doc_id, r.sequence_id, r.offset) for r in found}
    assert len(set(map(frozenset, packed.values()))) == 3
    assert corpus_pipeline.packing_stage(spark, docs.limit(0), "").collect() == []
