"""Url judgements, archive audits and the pipeline."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_dedup import WORD, groups, removed
from threadloom.llm import language, mixing, url_filter, warc

URLS = {
    "http://Blog.X.Example.COM/en/1?q=/x#y": ("blog.x.example.com", "/en/1", "example.com/en/", "block"),
    "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
    "https://a.www.example.com/en/z": ("a.www.example.com", "/en/z", "www.example.com/en/", "allow"),
    "ftp://shop.com/a": ("shop.com", "/a", "com/", "allow"),
    "http://shop.com": ("shop.com", "", None, None),
    "http://notcom/a": ("notcom", "/a", None, None),
    "http://a.net/es/?": ("a.net", "/es/", "net/es/", "block"),
    "http://net/fr/x://y": ("net", "/fr/x://y", "net/fr/", "block"),
    "a://b://c/d": ("b:", "//c/d", None, None),
    "x\n://Q.net/fr/1": ("q.net", "/fr/1", "net/fr/", "block"),
    "mailto:someone": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_hosts_paths_rules(spark):
    rows = [(i, url, None, "x") for i, url in enumerate(URLS)]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = list(URLS.values())[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == want[:3]
        assert want[3] in (None, r["verdict"])


def test_verdicts_follow_links(spark):
    link = lambda *to: "".join(f'<a HREF="http://{t}/">x</a><a href=/own>y</a>' for t in to)
    rows = [
        (1, "http://good.com/a", link("friend.org")), (2, "http://bad.net/es/", None), (3, "http://friend.org/", ""),
        (4, "http://suspect.org/x", link("bad.net")), (5, "http://lonely.org/", link("elsewhere.info")),
        (6, "http://second.org/", link("suspect.org") + "<a href='//bad.net'>"), (7, "http://bad.net/en/", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages).collect()}
    assert got == {1: "allow", 2: "block", 3: "allow", 4: "block", 5: "allow", 6: "block", 7: "block"}


def test_ranks_match_brute_force(spark):
    links = [("a", "b", 2), ("a", "a", 1), ("b", "c", 1), ("c", "a", 4), ("d", "c", 3), ("e", "f", 1)]
    seeds = [("a", 3, 0), ("c", 1, 2), ("z", 0, 1)]
    got = url_filter.ranks(
        spark.createDataFrame(links, "a string, b string, n long"),
        spark.createDataFrame(seeds, "host string, good long, bad long"), rounds=12, tolerance=0.0,
    )

    def rank(edges, seed):
        hosts = sorted({x for e in edges for x in e[:2]} | {s[0] for s in seeds})
        start = {h: seed.get(h, 0) / sum(seed.values()) for h in hosts}
        now = dict(start)
        out = {h: sum(n for a, _, n in edges if a == h) for h in hosts}
        for _ in range(12):
            sent = {h: sum(now[a] * n / out[a] for a, b, n in edges if b == h) for h in hosts}
            lost = 1 - sum(sent.values())
            now = {h: 0.85 * (sent[h] + lost * start[h]) + 0.15 * start[h] for h in hosts}
        return now

    trust = rank(links, {h: g for h, g, _ in seeds})
    distrust = rank([(b, a, n) for a, b, n in links], {h: x for h, _, x in seeds})
    for r in got.collect():
        assert abs(r["trust"] - trust[r["host"]]) < 1e-9 and abs(r["distrust"] - distrust[r["host"]]) < 1e-9


def test_distrust_reaches_the_end_of_a_long_chain(spark, monkeypatch):
    rows = [(i, f"http://h{i}.org/", f'<a href="http://h{i + 1}.org/">') for i in range(1, 25)]
    rows += [(25, "http://h25.org/", '<a href="http://bad.net/es/">'), (26, "http://bad.net/es/", None), (27, "http://lonely.org/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages, tolerance=1e-2).collect()}
    assert got == {i: "allow" if i == 27 else "block" for i in range(1, 28)}
    monkeypatch.setattr(url_filter, "GUARD", 3)
    with pytest.raises(RuntimeError):
        url_filter.ranks(
            spark.createDataFrame([("a", "b", 1)], "a string, b string, n long"),
            spark.createDataFrame([("a", 1, 0)], "host string, good long, bad long"), damping=1.0, tolerance=-1.0,
        )


def test_audit_finds_what_was_damaged(spark):
    rows = [(i, f"http://x/{i}", "é" * (i % 50)) for i in range(700)] + [(700, None, None), (None, "u", "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in warc.audit_pages(pages, file_bytes=40_000).collect()}
    hit = {i for i in range(701) if hashlib.md5(str(i).encode()).hexdigest().endswith("00")}
    assert hit and {i for i, r in got.items() if r["status"] == "damaged"} == hit and len(got) == 701
    assert all((r["digest"] != r["other_digest"]) == (i in hit) for i, r in got.items())
    ends = {}
    for r in sorted(got.values(), key=lambda r: (r["file"], r["place"])):
        assert r["offset"] == ends.get(r["file"], 0)
        ends[r["file"]] = r["offset"] + r["length"]


def test_audit_locates_changed_lengths_lost_and_added_records(spark):
    rows = [(i, f"text {i}") for i in range(0, 200, 2)] + [(70, "twice"), (70, "zwice")]
    copy = [(i, "cut" if i == 40 else f"{t} longer" if t == "twice" else t) for i, t in rows if i != 90] + [(21, "added")]
    sides = [warc.layout(warc.digests(spark.createDataFrame(r, "page_id long, record string")), 2) for r in (rows, copy)]
    got = [r for r in warc.audit(*sides, fanout=3).collect()]
    bad = sorted((r["page_id"], r["digest"] is None, r["other_digest"] is None) for r in got if r["status"] == "damaged")
    assert bad == [(21, True, False), (40, False, False), (70, False, False), (90, False, True)]
    assert len(got) == len(rows) + 1
    assert all(r["digest"] == r["other_digest"] for r in got if r["status"] == "intact")


def test_audit_of_missing_records_and_empty_tables(spark):
    rows = [(i, f"text {i}") for i in range(40)]
    full = warc.layout(warc.digests(spark.createDataFrame(rows, "page_id long, record string")), 1)
    part = warc.layout(warc.digests(spark.createDataFrame(rows[:-1], "page_id long, record string")), 1)
    got = warc.audit(full, part, fanout=3).where("status = 'damaged'").collect()
    assert [(r["page_id"], r["other_digest"]) for r in got] == [(39, None)]
    assert warc.audit(part, full, fanout=3).where("status = 'damaged'").first()["page_id"] == 39
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.audit_pages(empty).count() == 0
    assert url_filter.judge_urls(empty).count() == 0


@pytest.fixture(scope="module")
def fixture(spark):
    spoken = {"en": "the of and to in is that it onth eron", "de": "der die und nicht schlich zuver keit ung", "fr": "le les une dans pour eaux queou"}
    rows = []
    for i in range(240):
        lang = list(spoken)[i % 3]
        words = [f"{spoken[lang].split()[(i * 7 + j * j) % 7]}" + str((i * j) % 9) * (j % 2) for j in range(20 + i % 90)]
        rows.append((i, " ".join(words), lang, "abc"[i % 3]))
    passage = " ".join(f"the onth{j}" for j in range(40))
    rows += [(300 + i, f"{rows[i][1]} {passage}", rows[i][2], "a") for i in range(0, 30, 3)]
    rows += [(400, rows[5][1], "de", "b"), (401, None, None, None), (402, "12 34 --", "en", "a"), (403, rows[5][1], "de", "b")]
    return rows, spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, fixture):
    rows, docs = fixture
    texts = {r[0]: r[1] for r in rows}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeats", "mixing", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    after = stage["language"](spark, docs, "")
    assert after.columns == docs.columns
    assert {r["doc_id"] for r in after.collect()} == set(texts) - {401, 402}

    after = stage["near_duplicates"](spark, docs, "")
    found = groups([(i, t) for i, t in texts.items()], 5, 80)
    assert after.columns == docs.columns
    assert {r["doc_id"] for r in after.collect()} == {i for i, g in found.items() if g[2]}

    after = stage["repeats"](spark, docs, "")
    gone = removed(list(texts.items()), 20)
    want = {
        i: texts[i] if drop == 0 else kept for i, (n, drop, _, kept) in gone.items() if not (drop and drop == n)
    }
    assert after.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want
    assert all(r["n_chars"] == len(r["text"] or "") for r in after.collect())

    after = stage["mixing"](spark, docs, "")
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix(docs).collect()}
    got = {}
    for r in after.collect():
        got.setdefault(r["doc_id"], []).append(len(WORD.findall(r["text"] or "")))
    for i, (size, words) in taken.items():
        assert sum(got.get(i, [])) == words
        assert len(got.get(i, [])) == (-(-words // size) if size else 1)

    packed = stage["packing"](spark, docs, "").collect()
    assert {r["doc_id"] for r in packed} == set(texts)


def test_run_is_its_stages(spark, fixture, tmp_path):
    _, docs = fixture
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts = docs
    for name, function in corpus_pipeline.STAGES:
        texts = function(spark, texts, "")
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, rows)) == sorted(map(key, texts.collect()))


def test_clashing_names_and_score_stay(spark, fixture):
    _, docs = fixture
    wide = docs.withColumns({"score": F.lit(3), "lang_pred": F.lit("q"), "_text": F.lit(1)})
    got = corpus_pipeline.identify_language(spark, wide, "")
    assert got.columns == wide.columns and {r["score"] for r in got.select("score").collect()} == {3}
    assert language.UNKNOWN == "und" and re.fullmatch("und", language.UNKNOWN)


def test_stages_keep_rows_without_an_id_of_their_own(spark):
    long = " ".join(f"onth{j}" for j in range(60))
    rows = [
        (1, "the of and to eron", "en"), (None, "in is that it of", "en"), (2, "the and of is that onth", "en"),
        (2, "that of the and to it in", "en"), (None, None, None), (None, long, "en"), (7, long, "en"),
    ]
    extra = [(*r, "a", 1, 2, "k", True, 3, 4, 5) for r in rows]
    names = "doc_id long, text string, lang string, source string, _size int, _taken int, kept_text string, _gone boolean, _at int, _key int, _cut int"
    docs = spark.createDataFrame(extra, names).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    for name in ("near_duplicates", "repeats"):
        got = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
        assert got.columns == docs.columns
        texts = [r["text"] for r in got.collect()]
        # only one of the two equal long texts goes, whole
        assert sorted(map(str, texts)) == sorted(str(r[1]) for r in rows[:-1])
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    assert mixed.columns == docs.columns and {r["kept_text"] for r in mixed.select("kept_text").collect()} == {"k"}
