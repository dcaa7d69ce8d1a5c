"""How many rounds the components of links take, and which links the later steps of the join build on."""

import numpy as np

from titlepulse.llm import common, ngram_join
from titlepulse.llm.common import components


def rounds(monkeypatch, links):
    """The components by id, and how many tables were written for them."""
    labels = []
    write = common.stage
    monkeypatch.setattr(common, "stage", lambda df, label: labels.append(label) or write(df, label))
    found = {r.id: r.component_id for r in components(links, "t").collect()}
    monkeypatch.setattr(common, "stage", write)
    return found, len(labels)


def plain(links):
    of = {}
    for a, b in links:
        old, new = sorted((of.setdefault(a, a), of.setdefault(b, b)), reverse=True)
        of = {i: new if c == old else c for i, c in of.items()}
    return of


def test_stars_need_no_round(spark, monkeypatch):
    stars = [(n, n % 7) for n in range(7, 60)] + [(3, 3)]
    found, tables = rounds(monkeypatch, spark.createDataFrame(stars, "a long, b long"))
    assert found == plain(stars) and tables == 1


def test_links_added_to_stars_take_few_rounds(spark, monkeypatch):
    stars = [(n, n % 7) for n in range(7, 60)]
    found, tables = rounds(monkeypatch, spark.createDataFrame([*stars, (20, 30)], "a long, b long"))
    assert found == plain([*stars, (20, 30)]) and tables <= 3


def test_components_of_random_links(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    path = [(1000 + int(a), 1000 + int(b)) for a, b in zip(rng.permutation(80), rng.permutation(80))]
    links = links + path
    found = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    assert found == {i: c for i, c in plain(links).items() if i in {x for a, b in links if a != b for x in (a, b)}}


def test_cluster_links_stand_for_the_links_they_are_given(spark):
    docs = spark.createDataFrame([(i, f"a b c d e {i}") for i in range(6)], "doc_id long, text string")
    clusters = spark.createDataFrame([(i, 0) for i in range(6)], "id long, cluster long")
    given = spark.createDataFrame([(5, 4), (4, 2)], "a long, b long")
    found = {r.id: r.component_id for r in components(ngram_join.cluster_links(docs, clusters, given), "t").collect()}
    assert found[5] == found[4] == found[2] == 2
