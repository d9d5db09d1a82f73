from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sightline.llm import language_id as L
from sightline.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark, sf_small):
    return L.train(spark.read.parquet(f"{sf_small.replace('sf0.001', 'sf0.01')}/documents.parquet"))


def page(lang, text):
    return f'<html{lang}><head><style>x{{}}</style><script>var the="of"</script></head><!-- the --><p>{text}&copy;</p></html>'


PAGES = [
    (1, "https://a.example.org/x", page(' lang="en"', "the thing of the other and this")),
    (2, "https://a.example.org/y", page(" lang='de-AT'", "der die das und nicht ein ach keit")),
    (3, "https://A.example.org:80/z", page("", "")),
    (4, "http://user@b.example.net?x", page(" class=x lang=de", "")),
    (5, None, None), (6, "no address", page(' lang="xx"', "el de la que no")), (6, "no address", page(' lang="xx"', "el de la que no")), (None, "https://b.example.net", ""),
]


def brute(model, pages):
    """The same posterior, page by page."""
    import re

    rows = []
    for pid, url, html in pages:
        html = html or ""
        tag = re.search(r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,8})""", html)
        host = re.match(r"(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
        text = re.sub(r"&#?\w{1,20};", " ", re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", html))
        ll = model.log_likelihoods(pa.array([text]))[0]
        p = np.exp(ll - ll.max())
        rows.append((pid, tag[1].lower() if tag else "", host[1].lower() if host else "", ll - ll.max(), p / p.sum()))
    sums = defaultdict(lambda: np.zeros(len(model.languages)))
    for _, tag, host, _, p in rows:
        for key in ("all", ("tag", tag), ("host", host), ("suffix", host.rpartition(".")[2])):
            sums[key] += p
    out, n_tags = [], len({r[1] for r in rows})
    for pid, tag, host, ll, p in rows:
        own = lambda key: np.maximum(sums[key] - p, 0)  # noqa: B023, E731
        prior = (own("all") + 1) / (own("all").sum() + len(p))
        for key in (("suffix", host.rpartition(".")[2]), ("host", host)):
            prior = (own(key) + L.PRIOR_WEIGHT * prior) / (own(key).sum() + L.PRIOR_WEIGHT)
        fused = ll + np.log((own(("tag", tag)) + 0.5) / (own("all") + 0.5 * (n_tags + 1))) + np.log(prior)
        q = np.exp(fused - fused.max())
        out.append((pid, model.languages[int(fused.argmax())], round(float((q / q.sum()).max()), 9), tag, host))
    return sorted(out, key=str)


def test_against_brute_force(spark, model):
    pages = spark.createDataFrame([(*p, "c") for p in PAGES], "page_id long, url string, html string, host string")
    got = L.identify(pages, model).collect()
    assert sorted(((r.page_id, r.lang, round(r.probability, 9), r.declared, r.host) for r in got), key=str) == brute(model, PAGES)
    assert {r.page_id: r.suffix for r in got}[1] == "org"


def test_text_alone_on_held_out_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small.replace('sf0.001', 'sf0.01')}/documents.parquet")
    model, rows = L.train(docs, hold_out=True), docs.select("doc_id", "text", "lang").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    best = model.log_likelihoods(pa.array([r.text for r in held])).argmax(1)
    assert sum(model.languages[k] == r.lang for k, r in zip(best, held)) >= 0.95 * len(held)


def test_every_labelled_document_counts(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = spark.createDataFrame([(i, "words here", "en") for i in range(200) if i not in ids] + [(i, "nur hier", "de") for i in ids], "doc_id long, text string, lang string")
    assert L.train(docs).languages == ["de", "en"] and L.train(docs, hold_out=True).languages == ["en"]


def test_model_sums_to_one(model):
    assert np.allclose(np.exp(model.logs.astype(float)).sum(0), 1, atol=1e-3) and model.languages == ["de", "en", "es", "fr"]


def test_trigrams_stay_in_their_text():
    both = L._trigrams(pa.array(["abcd", "", None, "x", "efg h"]))
    apart = [L._trigrams(pa.array([t], pa.string()))[0].tolist() for t in ["abcd", "", None, "x", "efg h"]]
    assert both[0].tolist() == [s for a in apart for s in a] and both[1].tolist() == [k for k, a in enumerate(apart) for _ in a]


def test_odd_tables(spark, model):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en"), (3, "x", "")], "doc_id long, text string, lang string")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert L.train(docs.where("doc_id <> 2")) is None and L.train(docs.where("false")) is None
    assert {(r.lang, r.probability) for r in L.identify(pages, None).collect()} == {(None, 0.0)}
    assert {r.lang for r in L.identify(pages, L.train(docs)).collect()} == {"en"}
    assert L.identify(pages.where("false"), model).count() == 0


def test_query(spark, sf_small):
    got = QUERIES["op3_language_id"](spark, sf_small).collect()
    assert len(got) == spark.read.parquet(f"{sf_small}/pages.parquet").count()
    assert all(0.25 <= r.probability <= 1 + 1e-9 and not math.isnan(r.probability) for r in got)
    assert sum(r.lang == r.declared for r in got) >= 0.95 * len(got)
