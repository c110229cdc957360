"""Registered queries beside their SQL, on tables that hold what the given ones lack."""
import re

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from twinlens.llm import oracles, queries, url_redirects


def beside_sql(spark, name, table, df, folder):
    """The query's rows, after they proved equal to its SQL's."""
    df.write.parquet(f"{folder}/{table}.parquet")
    got = queries.queries()[name](spark, folder).toPandas()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    want = con.sql(oracles.SQL[name]).df()[list(got.columns)]
    assert sorted(map(str, got.astype(object).where(got.notna(), None).values.tolist())) == sorted(
        map(str, want.astype(object).where(want.notna(), None).values.tolist()))
    return got


def test_quality_query_asks_for_the_languages_words(spark, tmpdir_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()[["doc_id", "text", "lang"]]
    rng = np.random.default_rng(0)
    prose = docs[docs.text.fillna("").str.split().str.len().between(80, 2000)
                 & ~docs.text.fillna("").str.contains(r"[|!&$%*#]")]
    clean = prose.groupby("lang").head(6)
    gibberish = clean.assign(doc_id=clean.doc_id + 10**6, text=[
        re.sub(r"[a-z]{2,}", lambda m: "".join(rng.choice(list("bcdfghjklmnpqrtvwxz"), len(m[0]))), t) for t in clean.text])
    turn = {"en": "de", "de": "fr", "fr": "es", "es": "en"}
    foreign = clean.assign(doc_id=clean.doc_id + 2 * 10**6, lang=[turn[x] for x in clean.lang])
    odd = pd.DataFrame([(-1, None, "en"), (-2, "", None), (-3, "Ünï \n\t" * 40, None), (-3, "a b c " * 300, "xx"),
                        *[(-10 - i, " ".join(str(i * k % 97) for k in range(40 + 9 * i)), "numbers") for i in range(6)]],
                       columns=["doc_id", "text", "lang"])
    made = spark.createDataFrame(pd.concat([docs, gibberish, foreign, odd]).astype(object), "doc_id long, text string, lang string")
    got = beside_sql(spark, "op5_quality_divergence", "documents", made, tmpdir_path)
    kept = set(got.doc_id[got.kept])
    assert not kept & (set(gibberish.doc_id) | set(foreign.doc_id) | {-1, -2, -3})
    assert got[got.doc_id < -10].word_distance.max() > 0  # a language without a letter has short words all the same
    assert set(clean.doc_id) <= kept


def test_url_query_with_links_of_every_form(spark, tmpdir_path):
    rng = np.random.default_rng(3)
    folders = ["", "/", "/x", "/x/", "/x/y", "/de/1", "/de/2", "/de/3", "/fr/2", "/es/3", "/x.html"]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]

    def target(g):
        h = pick([f"a{g}.net", f"B{g}.net", f"d{g}.com", f"d{g}.com", f"e{g}.Example.org" if g % 5 == 0 else f"e{g}.com"])
        return pick([f"http://{h}{pick(folders)}", f"https://{h}{pick(folders)}#f", f"//{h}{pick(folders)}", pick(folders),
                     "../" * int(rng.integers(1, 4)) + "y", "./", ".", "..", "../..", "./k/../y", "k/..", "?a=/b", "#f",
                     "page" + str(rng.integers(4)), "mailto:a@b.com", "javascript:x()", "/../de/1", "/x/./y/", f"http://{h}/x/../y"])

    def html(g):
        return pick([None, "no link", f"<link rel='canonical' href='{target(g)}'>",
                     f'<META http-equiv="Refresh" content="0; URL={target(g)}">', "<link rel=canonical>",
                     f"<link href={target(g)} rel=canonical><meta http-equiv=refresh content='1;url={target(g)}'>"])

    rows = []
    for i in range(900):
        g = i % 90
        h = pick([f"a{g}.net", f"b{g}.net", f"C{g}.net", f"d{g}.com", f"s{i}.net"])
        rows.append((i, f"{pick(['http', 'https'])}://{h}{pick(folders)}{pick(['', '?q', '#g'])}", html(g)))
    rows += [(9001, None, html(1)), (9002, "no scheme", html(1)), (9002, "no scheme", html(1)), (9003, "http:///x", html(1)), (9004, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = beside_sql(spark, "op3_url_redirects", "pages", pages, tmpdir_path)
    free = got[got.rule.isna()]
    assert (free.verdict == "block").sum() > 10 and (free.verdict == "allow").sum() > 20


def test_dot_segments(spark):
    base = "http://h.net/a/b"
    want = {".": "/a/", "./": "/a/", "..": "/", "../": "/", "../..": "/", "../../..": "/", "k/..": "/a/", "./c": "/a/c",
            "../c/./d": "/c/d", "/./c": "/c", "c/../../d/": "/d/", "/x/..": "/", "c": "/a/c", "?q": "/a/b"}
    df = spark.createDataFrame([(base, k) for k in want], "base string, to string")
    out = df.select("to", url_redirects.path(url_redirects.resolved(F.col("base"), F.col("to"))).alias("p")).collect()
    assert {r.to: r.p for r in out} == want


def test_redirect_chains_equal_union_find(spark):
    rng = np.random.default_rng(8)
    n = 600
    url = [f"http://h{i}.{'com' if i % 3 else 'net'}{['/p', '/de/1', '/fr/1', '/q/'][i % 13 if i % 13 < 4 and i % 13 != 2 or i % 39 == 2 else 0]}" for i in range(n)]
    edges = [(int(a), int(b)) for a, b in rng.integers(0, n, (200, 2))] + [(i, i + 1) for i in range(0, 90)]
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[find(a)] = find(b)
    rule = [("allow" if "/fr/" in u else "block" if "/de/" in u else None) if ".com/" in u else None for u in url]
    said = {}
    for i in range(n):
        said.setdefault(find(i), set()).add(rule[i])
    want = {i: rule[i] or ("block" if "block" in said[find(i)] and "allow" not in said[find(i)] else "allow") for i in range(n)}
    assert 20 < sum(v == "block" for v, r in zip(want.values(), rule) if r is None)
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(url)], "page_id long, url string, html string")
    moves = spark.createDataFrame([(url[a], url[b]) for a, b in edges], "source_url string, target_url string")
    assert {r.page_id: r.verdict for r in url_redirects.judge(pages, moves).collect()} == want
