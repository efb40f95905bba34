"""Boilerplate lines against plain counting."""

import random
import re

import pytest

from shelfwise.llm import line_dedup


def plain(rows, ratio, min_pages, min_line_pages):
    bare = lambda line: re.sub(r"^[ \t\r]+|[ \t\r]+$", "", line)
    pages, total = {}, {}
    for _, site, text in rows:
        if site is not None:
            total[site] = total.get(site, 0) + 1
            for line in {bare(x) for x in (text or "").split("\n")} - {""}:
                pages[site, line] = pages.get((site, line), 0) + 1
    gone = {k for k, n in pages.items() if total[k[0]] >= min_pages and n >= min_line_pages and n > ratio * total[k[0]]}
    out = []
    for page, site, text in rows:
        lines = text.split("\n") if text is not None else []
        kept = [x for x in lines if (site, bare(x)) not in gone]
        out.append((page, site, len(lines), len(lines) - len(kept), "\n".join(kept) if text is not None else None))
    return out


def rows():
    rng = random.Random(1)
    out = []
    for i in range(120):
        site = rng.choice(["hot", "hot", "hot", "b", "small" if i % 20 == 0 else "c", None])
        lines = [f"only {i}", rng.choice(["menu", " menu\t", "about"]), "", rng.choice(["x", "y"]) * rng.randint(1, 40), "menu"]
        out.append((i, site, "\n".join(lines)))
    return out + [(500, "hot", None), (501, "hot", ""), (502, "hot", "\n\n"), (503, "hot", "menu"), (503, "hot", "menu"),
                  (None, "b", "menu\r\nkept"), (504, "b", "long " * 40_000 + "\nmenu")]


@pytest.mark.parametrize("ratio,min_pages,min_line_pages", [(0.05, 10, 5), (0.3, 1, 1), (0.9, 10, 2), (0.0, 1, 1)])
def test_equals_plain_counting(spark, ratio, min_pages, min_line_pages):
    frame = spark.createDataFrame([(*r, "z", 1, "w") for r in rows()], "page_id bigint, host string, text string, _site string, _drop int, _lines string")
    out = line_dedup.drop_boilerplate(frame, "host", "text", ratio, min_pages, min_line_pages)
    assert out.columns == [*frame.columns, "n_lines", "n_dropped"]
    got = [tuple(r) for r in out.select("page_id", "host", "n_lines", "n_dropped", "text").collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows(), ratio, min_pages, min_line_pages)))


def test_shuffle_join_gives_the_same(spark, monkeypatch):
    frame = spark.createDataFrame(rows(), "page_id bigint, host string, text string")
    want = sorted(map(str, line_dedup.drop_boilerplate(frame, "host", "text").collect()))
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", -1)
    assert sorted(map(str, line_dedup.drop_boilerplate(frame, "host", "text").collect())) == want


def test_native_and_empty(spark):
    frame = spark.createDataFrame(rows(), "page_id bigint, host string, text string")
    plan = line_dedup.drop_boilerplate(frame, "host", "text")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
    assert line_dedup.drop_boilerplate(frame.limit(0), "host", "text").count() == 0


def test_html_and_hosts(spark):
    frame = spark.createDataFrame([
        ("HTTPS://User@WWW.Example.com:80/a?b", "<p>a &amp;lt; b</p><script>x<p></script>c<br/>d<!-- <p>no -->e"),
        ("no url", None), (None, "plain < text"), ("http://h#x", "<STYLE a=b>p{}</STYLE ><Title>t</tItle>")], "url string, html string")
    got = frame.select(line_dedup.host(frame.url).alias("h"), line_dedup.html_text(frame.html).alias("t")).collect()
    assert [r.h for r in got] == ["www.example.com", None, None, "h"]
    assert [r.t for r in got] == ["\na &lt; b\n c\nd e", None, "plain < text", " \nt\n"]


def test_long_lines_stay_in_the_first_document_only(spark):
    passage, other = (" ".join(f"{w}{k}" for k in range(51)) for w in "pq")
    fifty = " ".join(f"r{k}" for k in range(50))
    given = [(1, "a", "own 1\n" + passage), (2, "b", f"own 2\n {passage}\t\n{fifty}\n\nend"), (None, None, f"{passage}\n{other}"),
             (4, "a", f"{other}\n{other}\nshort"), (5, "a", None), (6, "a", ""), (7, "b", f"{fifty}\nshort"), (4, "a", f"{other}\n{other}\nshort")]
    given += [(100 + i, f"s{i}", f"only {i}\n{passage}") for i in range(60)]
    frame = spark.createDataFrame([(*r, len(r[2] or "")) for r in given], "doc_id bigint, source string, text string, n_chars bigint").repartition(5)
    want = [(1, given[0][2]), (2, f"own 2\n{fifty}\n\nend"), (None, ""), (4, given[3][2]), (4, given[3][2]), (5, None), (6, ""), (7, given[6][2])]
    want += [(100 + i, f"only {i}") for i in range(60)]
    out = line_dedup.drop_repeats(frame, "doc_id", "text")
    assert out.columns == [*frame.columns, "n_repeats"]
    assert sorted(map(str, [(r.doc_id, r.text) for r in out.collect()])) == sorted(map(str, want))
    assert {r.doc_id: r.n_repeats for r in out.collect()} == {i: 2 if i is None else int(i == 2 or i >= 100) for i in [r[0] for r in given]}

    import corpus_pipeline

    staged = corpus_pipeline.without_boilerplate(spark, frame, "")
    assert sorted(map(str, [(r.doc_id, r.text, r.n_chars) for r in staged.collect()])) == sorted(
        str((i, t, len(t or ""))) for i, t in want)
    assert line_dedup.drop_repeats(frame.limit(0), "doc_id", "text").count() == 0
