"""Operators that judge one row at a time: quality rules, personal data, URL filter; and the classifier."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from tests_llm_helpers import corpus, frame, ready, words  # noqa: F401
from titlepulse.llm import pii, quality_classifier, quality_rules, url_filter


def plain_quality(text):
    text = text or ""
    split = words(text)
    windows = Counter(tuple(split[n : n + 5]) for n in range(len(split) - 4))
    covered = {n + k for n in range(len(split) - 4) if windows[tuple(split[n : n + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(split), sum(len(w.decode()) for w in split), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_equal_brute_force(frame):
    rows = corpus(7) + [(500, "a b c d e a b c d e a b"), (501, "x\n\nx\n x\nx # * $ 日本"), (502, "a a a a a a a a a a a a"), (503, "Ünï-\x0b\x0cx " * 30)]
    found = quality_rules.judge(frame(rows)).collect()
    found = [(d.doc_id, d.judged) for d in found]
    mine = [(i, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for i, r in found]
    assert sorted(mine, key=str) == sorted([(i, plain_quality(t)) for i, t in rows], key=str)
    for _, r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (r.failed_rule is None) and not (r.base_failed and r.kept)


def test_quality_rules_keep_what_they_should(frame):
    rng = random.Random(1)
    clean = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(80)) + "."
    rows = [(1, clean), (2, clean.upper()), (3, clean.replace(" ", "! ")), (4, clean.replace(" ", " # ")), (5, None), (6, "too short"), (7, " ".join("12 34 56 78 90".split() + [str(n) for n in range(50)]))]
    kept = {r.doc_id: r.judged.kept for r in quality_rules.judge(frame(rows)).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: False}


def test_pipeline_keeps_clean_short_texts_with_numbers(spark, frame):
    import corpus_pipeline

    rows = [  # rated as good and not toxic in the generated table
        (4895, "Erheit sich enachge die verlich enkeitzu +1 (372) 555-7739 einverte 9597024294303453 beung."),
        (8558, "Raie ta.\nQue osra ostado ardo lo +1 (887) 555-2355 ciónóciue, 4407620926593142 del cióndoó."),
        (9138, "4501042323994846 Anth heoron, it for +1 (984) 555-5227 ofonntndon 224.228.19.86 thon, ha oferesonble hain thing tionhaed erenouou."),
    ]
    line = "And therhean is the is esndha."
    rows.append((30, "\n".join([line, " ".join(f"word{n}" for n in range(60)), line])))
    bad = (1, " ".join("12 34 56 78 90".split() + [str(n) for n in range(50)]))
    docs = frame([*rows, bad], clash=False)
    assert sorted(r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, "").collect()) == [30, 4895, 8558, 9138]
    assert not any(r.judged.kept for r in quality_rules.judge(docs).collect())


def test_cascade_order_is_by_rejections_per_cost(frame):
    rows = [(n, ("ABC DEF " if n < 8 else "abc def ") * 10 + str(n)) for n in range(10)]
    cheap = quality_rules.Rule("cheap", "n_words < 0")
    dear = quality_rules.Rule("dear", "upper(_text) = _text", per_char=1000.0)
    fair = quality_rules.Rule("fair", "upper(_text) = _text", per_char=1.0)
    measured = quality_rules.measured(frame(rows, clash=False))
    assert [r.name for r in quality_rules.cascade_order(measured, [cheap, dear, fair])] == ["fair", "dear", "cheap"]


def test_quality_rules_of_an_empty_table(frame):
    assert quality_rules.judge(frame([])).collect() == []


def test_no_python_and_no_shuffle_in_quality_rules(spark, frame):
    plan = quality_rules.judge(frame(corpus(7)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_spans(frame):
    text = "Ä mail a.b@x.example.com, ip 10.0.255.1 and 10.0.256.1, card 4111-1111-1111-1111 or 4111 1111 1111 1112, call +49 (30) 1234567."
    base = [s for s in pii.spans_of(text) if s[1] < 4]
    assert [(pii.KINDS[k].name, text[a:b]) for a, k, b, _ in base] == [
        ("email", "a.b@x.example.com"), ("ip", "10.0.255.1"), ("card", "4111-1111-1111-1111"), ("phone", "+49 (30) 1234567")]
    assert pii.spans_of("no 0.0.0." + "0" * 6000 + "1 here")[0][1] == 1
    row = pii.find(frame([(1, text)])).first()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    assert row.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k].name}:{a}:{b}" for a, k, b, _ in base).encode()).hexdigest()


def test_validators_and_context():
    kinds = lambda text: [pii.KINDS[s[1]].name for s in pii.spans_of(text)]
    assert kinds("iban DE89 3704 0044 0532 0130 00 ok") == ["iban"]
    assert "iban" not in kinds("iban DE88 3704 0044 0532 0130 00 ok")
    assert kinds("ssn 219-09-9999") == ["national_id"] and kinds("part 219-09-9999") == []
    assert kinds("visa 4222222222222") == ["card13"] and kinds("number 4222222222222") == []
    assert not pii.luhn("4222222222223") and pii.luhn("4222222222222")


def test_ibans_before_short_words_in_capitals():
    ibans = lambda text: [text[a:b] for a, k, b, _ in pii.spans_of(text) if pii.KINDS[k].name == "iban"]
    valid = ["BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "PL61 1090 1014 0000 0712 1981 2874", "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00"]
    for iban in [*valid, *[v.replace(" ", "") for v in valid]]:
        for after in ("", " now", " EUR 250", " BIC X", " ACME CORP", " 2024 12", ", X"):
            assert ibans(f"to {iban}{after}") == [iban], (iban, after)
    assert ibans("REF XY99 BE68 5390 0754 7034 EUR") == ["BE68 5390 0754 7034"]
    assert ibans("BE68 5390 0754 7034 EUR AT61 1904 3002 3457 3201 USD") == ["BE68 5390 0754 7034", "AT61 1904 3002 3457 3201"]
    assert ibans("BE68 5390 0754 7035 EUR 250") == []
    assert pii.redacted("pay BE68 5390 0754 7034 EUR 250") == "pay [IBAN] EUR 250"


def test_redaction_takes_effect_and_edges(frame):
    rows = [(1, "mail me at joe@example.com now"), (2, None), (3, ""), (4, "nothing here"), (None, "call +1 555 123 4567"), (5, "x" * 200_000)]
    found = pii.redact(frame(rows)).collect()
    assert [r.text for r in found][:5] == ["mail me at [EMAIL] now", None, "", "nothing here", "call [PHONE]"]
    assert found[0].n_chars == len(found[0].text) and found[1].n_chars is None
    assert pii.redact(frame([])).collect() == [] and pii.find(frame([])).collect() == []


def test_url_rules(spark):
    urls = ["https://a.example.org/es/1?x", "http://EXAMPLE.org/en/12", "http://example.org", "ftp://x.org/", "http://b.com/fr/1", "http://b.com/de/#t", "http://notexample.org/es/1", None, "b.com/de/1", "", "http://x.net/p://q", "http://com/de/x"]
    pages = spark.createDataFrame([(n, u, None, 1) for n, u in enumerate(urls)], "page_id long, url string, html string, host long")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert found == {
        0: ("a.example.org", "/es/1", "example.org/es/", "block"), 1: ("example.org", "/en/12", "example.org/en/1", "block"), 2: ("example.org", "", None, "allow"),
        3: ("x.org", "/", "org/", "allow"), 4: ("b.com", "/fr/1", "com/fr/", "allow"), 5: ("b.com", "/de/", "com/de/", "block"), 6: ("notexample.org", "/es/1", "org/", "allow"),
        7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("x.net", "/p://q", None, "allow"), 11: ("com", "/de/x", "com/de/", "block")}
    assert url_filter.judge(pages.limit(0)).collect() == []


def plain_rank(seeds, edges, steps):
    total = sum(seeds.values())
    start = {h: w / total for h, w in seeds.items()}
    out = Counter()
    for (a, _), n in edges.items():
        out[a] += n
    ranks = dict(start)
    for _ in range(steps):
        new = Counter({h: (1 - url_filter.DAMPING) * s for h, s in start.items()})
        for (a, b), n in edges.items():
            if a in ranks:
                new[b] += url_filter.DAMPING * ranks[a] * n / out[a]
        ranks = new
    return ranks


def test_link_graph_spreads_trust_and_distrust(spark):
    link = lambda *hosts: " ".join(f'<a HREF="http://{h}/x">' for h in hosts)
    pages = [("http://good.org/", link("friend.net")), ("http://bad.com/de/1", link("bad.com")), ("http://farm.net/", link("bad.com", "bad.com", "friend.net")), ("http://friend.net/", link("mate.net")), ("http://mate.net/", None), ("http://alone.net/", "<a href='/x'>")]
    frame = spark.createDataFrame([(n, *p) for n, p in enumerate(pages)], "page_id long, url string, html string")
    found = {r.host: r.verdict for r in url_filter.judge(frame).collect()}
    assert found == {"good.org": "allow", "bad.com": "block", "farm.net": "block", "friend.net": "allow", "mate.net": "allow", "alone.net": "allow"}
    edges = {("good.org", "friend.net"): 1, ("farm.net", "bad.com"): 2, ("farm.net", "friend.net"): 1, ("friend.net", "mate.net"): 1}
    assert {(r.src, r.dst): r.n for r in url_filter.host_edges(frame).collect()} == edges
    along = spark.createDataFrame([(a, b, n / sum(m for (x, _), m in edges.items() if x == a)) for (a, b), n in edges.items()], "src string, dst string, share double")
    ranks = {r.host: r.score for r in url_filter.spread(spark.createDataFrame([("good.org", 1.0)], "host string, weight double"), along, "t", 4).collect()}
    for host, score in plain_rank({"good.org": 1.0}, edges, 4).items():
        assert abs(ranks[host] - score) < 1e-12


def test_every_blocked_page_makes_its_host_a_seed(spark):
    link = lambda *hosts: " ".join(f"<a href='//{h}/x'>" for h in hosts)
    pages = [*[("http://part.com/de/1", None)] * 9, *[("http://part.com/x", None)] * 11, ("http://farm.net/", link("part.com")), ("http://alone.net/", None)]
    # As many pages blocked, but trusted hosts link to the one that links there.
    pages += [*[("http://mixed.com/de/1", None)] * 9, *[("http://mixed.com/fr/1", None)] * 10, ("http://mixed.com/x", None), ("http://fan.net/", link("mixed.com")), ("http://good.org/", link("fan.net", "fan.net"))]
    frame = spark.createDataFrame([(n, *p) for n, p in enumerate(pages)], "page_id long, url string, html string")
    found = {(r.host, r.path): r.verdict for r in url_filter.judge(frame).collect()}
    assert found == {
        ("part.com", "/de/1"): "block", ("part.com", "/x"): "allow", ("farm.net", "/"): "block", ("alone.net", "/"): "allow",
        ("mixed.com", "/de/1"): "block", ("mixed.com", "/fr/1"): "allow", ("mixed.com", "/x"): "allow", ("fan.net", "/"): "allow", ("good.org", "/"): "allow"}
    assert {(r.src, r.dst): r.n for r in url_filter.host_edges(frame).collect()} == {("farm.net", "part.com"): 1, ("fan.net", "mixed.com"): 1, ("good.org", "fan.net"): 2}


def rated(rng, n, kind):
    good = [f"word{k}" for k in range(200)]
    text = [rng.choice(good) for _ in range(rng.randint(40, 200))]
    if kind == 0:
        text[rng.randrange(len(text))] = rng.choice(["vile", "scum"])
    if kind == 1:
        text = [t.upper() + "!!" for t in text]
    return (n, " ".join(text))


def test_classifier_on_held_out_ratings(spark, frame):
    rng = random.Random(2)
    kinds = [rng.choice([0, 1, 2, 2, 2]) for _ in range(600)]
    rows = [rated(rng, n, k) for n, k in enumerate(kinds)]
    labels = spark.createDataFrame([(n, 0 if k == 1 else 1, 1 if k == 0 else 0) for n, k in enumerate(kinds[:400])] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality_classifier.grade(frame(rows), labels).collect()}
    right = sum(found[n].kept == (kinds[n] == 2) for n in range(400, 600))
    assert right >= 190
    for r in found.values():
        assert 0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1


def test_classifier_without_ratings_and_edges(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality_classifier.grade(frame([(1, None), (None, "x"), (2, "")]), none).collect()
    assert [(r.kept, r.expected_grade) for r in found] == [(True, None)] * 3
    assert quality_classifier.grade(frame([]), none).collect() == []
    weights, thresholds = quality_classifier.fit([quality_classifier.features(t) for t in ("a b", "c d", "e f")] * 5, __import__("numpy").array([0, 1, 2] * 5))
    assert list(thresholds) == sorted(thresholds)


def test_base_kinds_equal_the_given_patterns():
    given = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= sum(c.isdigit() for c in m) <= 19 and plain_luhn(m)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= sum(c.isdigit() for c in m) <= 15),
    }

    def plain_luhn(text):
        digits = [int(c) for c in reversed(text) if c.isdigit()]
        return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0

    rng = random.Random(6)
    bits = ["a", "b@", "@", ".", "-", "%", "x.y", "1", "25", "256", "0", ".1", "1.2.3.4", " ", "+1", "(", ")", "é", "a@b.c", "4111 1111 1111 1111", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))
        expected = sorted((m.start(), n, m.end()) for n, (pattern, check) in enumerate(given.values()) for m in re.finditer(pattern, text) if check(m.group()))
        assert [s[:3] for s in pii.spans_of(text, pii.BASE_KINDS)] == expected, text


@pytest.mark.parametrize("text", ["1" * 1_000_000 + " 1.2", "a" * 1_000_000 + " @", "a." * 500_000 + "@x", "1." * 500_000, "+1" + " " * 1_000_000, "1 " * 500_000 + "@.-+", "@a" * 500_000, "AB12" * 250_000 + "."])
def test_long_texts_take_linear_time(text):
    start = time.perf_counter()
    pii.spans_of(text)
    assert time.perf_counter() - start < 5  # a second on a machine that is not busy; quadratic time would be hours
