"""Layouts on documents of each source, requests and their cache, paging, ledgers, days of a run."""

from __future__ import annotations

import base64
import io
import json
import urllib.error
from datetime import date

import pytest
from pyspark.sql import functions as F

from lexloom import config
from lexloom.operators import health, instructions
from lexloom.sources import http, layouts, ledger, registry
from lexloom.sources.layout_table import LAYOUTS, SAMPLES
from lexloom.streaming import days


def test_every_source_has_a_layout_and_a_sample():
    assert set(LAYOUTS) == set(SAMPLES) == {x.code for x in registry.SOURCES}


def test_ranks():
    assert layouts.rank_of("Gesetz über die Landesbank", LAYOUTS["li"]) == "gesetz"
    assert layouts.rank_of("Verfassungsgesetz", LAYOUTS["li"]) == "verfassungsgesetz"
    assert layouts.rank_of("Umowa międzynarodowa", LAYOUTS["pl"]) == "umowa_miedzynarodowa"
    assert layouts.rank_of("Decreto Legislativo nº 4", LAYOUTS["co"]) == "decreto_legislativo_no_4"
    assert layouts.rank_of(None, LAYOUTS["es"]) == "otro" and layouts.rank_of("1290", LAYOUTS["es"]) == "ley_organica"


def test_days_of_all_forms():
    assert [layouts.day(x) for x in ("19951231", "1995-12-31T10:00", "31.12.1995", "1/2/1995", "99991231", "1995-13-01", "", None)] == ["1995-12-31"] * 3 + ["1995-02-01", None, None, None, None]
    assert layouts.day("02/01/1995", month_first=True) == "1995-02-01"


def test_statuses():
    head = "<documento><metadatos>{}</metadatos></documento>"
    said = {"<estatus_derogacion>T</estatus_derogacion>": "repealed", "<estatus_derogacion>N</estatus_derogacion><estatus_anulacion>S</estatus_anulacion>": "annulled", "<estatus_derogacion>N</estatus_derogacion><vigencia_agotada>S</vigencia_agotada>": "expired", "<estatus_derogacion>N</estatus_derogacion>": "in_force"}
    assert {k: layouts.document(LAYOUTS["es"], head.format(k))[0]["status"] for k in said} == said


def test_packed_versions():
    clml = "<Legislation><Body><P1 id='s1'><Pnumber>1</Pnumber><P1para><Text>a &amp; b</Text></P1para></P1></Body></Legislation>"
    blob = json.dumps({"versions": [{"effective_date": "2000-01-02", "xml_b64": base64.b64encode(clml.encode()).decode()}]})
    _, units, error = layouts.document(LAYOUTS["uk"], blob)
    assert error is None and [(u.unit, u.eff, u.paras) for u in units] == [("s1", "2000-01-02", ["a & b"])]


def test_broken_documents_say_so(spark):
    rows = [("whole", b"<documento><texto><bloque id='a'><version fecha_publicacion='20000101'><p>x</p></version></bloque></texto></documento>"), ("cut", b"<documento><texto><bloque id='a'><version fecha_publicacion='20000101'><p>x"), ("empty", b""), ("null", None), ("other", "{\"a\": 1}".encode())]
    got = {r["norm"]: r for r in layouts.read(spark.createDataFrame(rows, "norm string, content binary"), LAYOUTS["es"]).collect()}
    assert got["whole"]["error"] is None and got["whole"]["text"] == got["cut"]["text"] == "x"
    assert got["cut"]["error"].startswith("xml:") and got["empty"]["error"] == got["null"]["error"] == "empty document"
    assert got["other"]["unit"] is None and got["other"]["error"]
    [bad] = layouts.read(spark.createDataFrame([("j", b"{")], "norm string, content binary"), LAYOUTS["lt"]).collect()
    assert bad["error"].startswith("json:")


def test_html_with_ends_left_out():
    root, _ = layouts.tree("<div><p>one<p>two<br>three<ul><li>a<li>b</ul></div>", "html")
    assert [x.text() for x in layouts.find(root, "p")] == ["one", "two three a b"] and [x.text() for x in layouts.find(root, "li")] == ["a", "b"]


class _Answer(io.BytesIO):
    def __init__(self, body, status=200, headers=None):
        super().__init__(body)
        self.status, self.headers = status, headers or {}


def _opening(answers, seen=None):
    def open_url(request, timeout):
        if seen is not None:
            seen.append(request)
        got = answers.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    return open_url


def _error(status, body=b"", headers=None):
    return urllib.error.HTTPError("u", status, "x", headers or {}, io.BytesIO(body))


def test_requests_are_tried_again_and_refused():
    waits = []
    client = http.Client(rate=0, open_url=_opening([_error(503), _error(429), _Answer(b"ok")]), sleep=waits.append)
    assert client.get("http://x/").body == b"ok" and waits == [1, 2]
    client.open_url = _opening([_error(404, b"<html><style>p{}</style><p>no  such\npage</p>")])
    with pytest.raises(http.Refused, match="no such page") as refused:
        client.get("http://x/")
    assert not refused.value.transient
    client.open_url = _opening([urllib.error.URLError("down")] * 3)
    with pytest.raises(http.Refused, match="down") as refused:
        client.get("http://x/")
    assert refused.value.transient


def test_posts_carry_their_body():
    seen = []
    http.Client(rate=0, open_url=_opening([_Answer(b"{}")], seen)).post("http://x/", {"q": 1})
    assert seen[0].data == b'{"q": 1}' and seen[0].get_method() == "POST" and seen[0].headers["Content-type"] == "application/json"


def test_rate_spaces_requests():
    now, slept = [0.0], []
    rate = http.Rate(4, clock=lambda: now[0], sleep=lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    for _ in range(4):
        rate.wait()
    assert slept == [0.25] * 3
    now[0] += 10
    rate.wait()
    assert len(slept) == 3


def test_cache_and_conditional_requests(tmp_path):
    now, seen = [1000.0], []
    cache = http.Cache(str(tmp_path / "c"), hours=1, now=lambda: now[0])
    answers = [_Answer(b"one", headers={"ETag": "e1", "Last-Modified": "monday"}), _error(304), _Answer(b"two", headers={"ETag": "e2"})]
    client = http.Client(rate=0, open_url=_opening(answers, seen))
    assert client.fresh("http://x/", cache).body == b"one" and client.fresh("http://x/", cache).cached and len(seen) == 1
    now[0] += 4000
    again = client.fresh("http://x/", cache)
    assert again.body == b"one" and again.status == 304 and seen[1].headers["If-none-match"] == "e1" and seen[1].headers["If-modified-since"] == "monday"
    assert client.fresh("http://x/", cache).cached and len(seen) == 2
    now[0] += 4000
    assert client.fresh("http://x/", cache).body == b"two" and cache.get("http://x/").headers == {"ETag": "e2"}
    cache.invalidate("http://x/")
    assert cache.get("http://x/", any_age=True) is None
    cache.put("a", b"x", {})
    cache.clear()
    assert cache.get("a") is None and not [x for x in (tmp_path / "c").iterdir()]


def test_halving_loses_nothing():
    held = {k: [f"{k}-{i}" for i in range(k % 7)] for k in range(40)}
    asked = []

    def ask(keys):
        asked.append(keys)
        return [x for k in keys for x in held[k]][:8]

    assert http.halved(list(held), ask, 8) == [x for rows in held.values() for x in rows]
    assert len(asked) > 10 and http.halved([], ask, 8) == []
    with pytest.raises(ValueError, match="may be cut"):
        http.halved([1], lambda keys: list(range(8)), 8)


def test_probing_stops_after_misses():
    there = {1, 2, 4, 9, 20}
    assert http.probed(lambda n: n if n in there else None) == [1, 2, 4, 9]
    assert http.probed(lambda n: n if n in there else None, misses=11) == [1, 2, 4, 9, 20]


def test_failures_are_cleared_and_reopened(spark, tmp_path):
    book = ledger.Failures(spark, f"file://{tmp_path}/failures")
    rows = lambda *x: spark.createDataFrame(list(x), "key string, reason string, status int")
    keys = lambda *x: spark.createDataFrame([(k,) for k in x], "key string")
    assert book.current().count() == 0
    book.record(rows(("a", "timeout", None), ("b", "gone", 404), ("c", "x" * 900, 503)), "2024-01-01")
    book.clear(keys("a", "z"), "2024-01-02")
    assert {(r["key"], r["transient"], len(r["reason"])) for r in book.current().collect()} == {("b", False, 4), ("c", True, 500)}
    assert {r["key"] for r in book.unresolved(keys("a", "b", "c", "d")).collect()} == {"a", "c", "d"}
    book.record(rows(("a", "again", 500)), "2024-01-03")
    assert {r["key"] for r in book.current().collect()} == {"a", "b", "c"}


def test_plan_of_days():
    d = lambda n: date(2024, 1, n)
    assert days.planned(d(20)) is None and days.planned(d(20), only=d(3)).days == (d(3),)
    assert days.planned(d(20), state=d(18)).days == (d(19), d(20))
    assert days.planned(d(20), state=d(18), log=d(16)).days == (d(17), d(18), d(19), d(20))
    assert days.planned(d(20), log=d(18)).days == (d(19), d(20))
    late = days.planned(d(20), state=d(5))
    assert late.days[0] == d(10) and late.dropped == (d(6), d(9))
    assert days.planned(d(20), log=d(5)).dropped is None and days.planned(d(20), state=d(9), log=d(1)).dropped is None
    assert days.planned(d(20), state=d(5), since=d(2)).days[0] == d(2) and days.planned(d(20), state=d(5), since=d(2)).dropped is None
    assert days.planned(d(21), state=d(18), skip={5, 6}).days == (d(19),)
    assert days.planned(d(20), state=d(25)).days == ()


def test_cursor_stops_before_a_failed_day(spark, tmp_path):
    d = lambda n: date(2024, 1, n)
    state, seen = days.State(f"file://{tmp_path}/state", cursor=d(10)), []

    def process(day, pending):
        seen.append((day, pending))
        if day == d(12):
            raise ValueError("bad day")
        return 2, {"k": "not yet"} if day == d(14) else {}, {"old"}

    state.pending = {"old": "waits"}
    report = days.run(spark, state, d(14), process)
    assert [x for x, _ in seen] == [d(11), d(12), d(13), d(14)] and report.published == 6 and state.cursor == d(11)
    assert state.pending == {"k": "not yet"} and len(report.errors) == 2
    with pytest.raises(RuntimeError, match="bad day"):
        report.end()
    again = days.State.load(spark, state.path)
    assert again.cursor == d(11) and again.pending == {"k": "not yet"} and again.runs == state.runs == 4
    assert days.State.load(spark, f"file://{tmp_path}/none").cursor is None


def test_days_beyond_the_budget_are_put_off(spark, tmp_path):
    clock = iter([0, 1, 5, 20, 30])
    state = days.State(f"file://{tmp_path}/state", cursor=date(2024, 1, 10))
    report = days.run(spark, state, date(2024, 1, 14), lambda d, p: (1, {}, set()), clock=lambda: next(clock), budget=10)
    assert len(report.days) == 2 and report.put_off == [date(2024, 1, 13), date(2024, 1, 14)] and state.cursor == date(2024, 1, 12)


def test_settings(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("chunk_events: 5\nsources:\n  fr:\n    rate: 2\n")
    got = config.load(str(path), {"sources.fr.rate": 4, "sources.es.rate": 1, "lookback_days": None, "a.b.c": 1})
    assert got["chunk_events"] == 5 and got["lookback_days"] == 10 and got["a"] == {"b": {"c": 1}}
    assert config.of_source(got, "fr") | {"a": 0} == {**config.DEFAULTS, "chunk_events": 5, "rate": 4, "a": 0}
    assert config.load(str(tmp_path / "none.yaml")) == config.DEFAULTS
    (tmp_path / "c.json").write_text('{"x": 1}')
    assert config.load(str(tmp_path / "c.json"))["x"] == 1


def test_orders_of_an_act(spark):
    text = """Visto. Art. 1° - Sustitúyese el artículo 8 BIS de la Ley N° 19.550 por el siguiente: "Artículo 8° bis: Texto: nuevo."
Art. 2° - Deróganse los artículos 11, 12 y 13 ter de la Ley 19550. Derógase el artículo 4° de la Ley N° 20.000."""
    acts = spark.createDataFrame([(1, text), (2, None), (3, "nada")], "act int, text string")
    got = sorted((r["kind"], r["law"], r["article"], r["wording"]) for r in instructions.orders(acts).collect())
    assert got == [("repeal", "19550", "11", ""), ("repeal", "19550", "12", ""), ("repeal", "19550", "13 ter", ""), ("repeal", "20000", "4", ""), ("substitute", "19550", "8 bis", "Texto: nuevo.")]
    assert instructions.orders(acts, law="20000").count() == 1


def test_health_finds_each_fault(spark):
    frame = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    files = frame("key string, path string, text string, published date", ("a", "x/a.md", "# A\n\n" + "text " * 20, date(2000, 1, 1)), ("a", "y/a.md", "", None), ("b", "x/b.md", "tiny", None), ("c", "z/c.md", "# C\n\n" + "w " * 40 + "\n\n## Empty\n", None))
    events = frame("key string, day date, source string", ("a", date(1970, 1, 2), "s"), ("a", date(1970, 1, 2), "s"), ("b", date(2024, 5, 1), "s"), ("c", date(2040, 1, 1), "s"), ("q", date(2000, 1, 1), "s"))
    excluded = frame("key string, reason string, transient boolean", ("d", "timeout", True), ("e", "not fetched", False), ("b", "scope", False))
    fields = frame("field string, seen long, carried long", ("f", 100, 2), ("g", 100, 95), ("h", 100, 100))
    known = lambda *x: frame("key string", *[(k,) for k in x])
    got = {r["finding"]: (r["severity"], r["n"], r["examples"]) for r in health.report(files, known("a", "b", "n"), events, known("a", "d", "x"), excluded, "2024-01-01", lambda k: F.concat(F.lit("x/"), k, F.lit(".md")), fields, deep=True).collect()}
    assert got == {
        "identifier claimed by more than one file": ("ERROR", 1, "a"), "data that never became a file": ("ERROR", 1, "n"), "file without data behind it": ("ERROR", 1, "c"), "discovered, neither published nor excluded": ("ERROR", 1, "x"),
        "excluded for a failure that may pass": ("ERROR", 1, "d"), "excluded without a reason": ("WARN", 1, "e"), "published and excluded at once": ("ERROR", 1, "b"), "event of a norm without a file": ("ERROR", 1, "q"), "event with an epoch day": ("WARN", 2, "a"),
        "event in the near future": ("WARN", 1, "b"), "event in the far future": ("ERROR", 1, "c"), "event told twice": ("ERROR", 1, "a"), "file not where the layout says": ("ERROR", 2, "y/a.md, z/c.md"), "empty file": ("ERROR", 1, "y/a.md"), "file under 50 bytes": ("WARN", 1, "x/b.md"),
        "heading without a text": ("ERROR", 1, "z/c.md"), "field of the source that no file carries": ("ERROR", 1, "f"), "field of the source that some files lose": ("WARN", 1, "g")}


def test_plugins_load_what_they_name():
    assert registry.plugin("fr").layout is LAYOUTS["fr"] and registry.plugin("fr").hook("daily") is None
    registry.hook("fr", "daily", "lexloom.streaming.days:run")
    assert registry.plugin("fr").hook("daily") is days.run and registry.plugin("es").hook("daily") is None
    registry._hooks.clear()
    with pytest.raises(ValueError, match="no such hook"):
        registry.plugin("fr").hook("other")
    with pytest.raises(KeyError):
        registry.plugin("xx")


def test_maps_can_be_put_in(spark):
    docs = spark.createDataFrame([("1", SAMPLES["fr"].text.encode())], "norm string, content binary")
    got = registry.plugin("fr").read(docs, ranks={"CODE": "kodex"}, rank_else="?")
    assert {r["rank"] for r in got.collect()} == {"kodex"}


def test_identifiers_of_other_forms(spark):
    from lexloom.functions import identifiers

    texts = {"http://data.europa.eu/eli/dir/2016/1164/oj": ("eli", None, "dir", "2016", "1164"), "https://data.dre.pt/eli/lei/7/2009/02/12/p": None, "32016R0679": ("celex", None, "R", "2016", "0679"), "02016R0679-20160504": ("celex", None, "R", "2016", "0679"), "http://www.legislation.gov.uk/id/asp/2003/4": ("statute", None, "asp", "2003", "4"),
             "/us/usc/t5/s101": ("code", "us", "usc", None, "5"), "urn:nir:stato:legge:1990-08-07;241": ("urn", "stato", "legge", "1990", "241"), "SFS 1998:204": ("yearly", None, None, "1998", "204"), "nothing": None, "": None}
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select("t", identifiers.parsed(F.col("t")).alias("p")).collect()
    got = {r["t"]: None if r["p"] is None else tuple(r["p"]) for r in rows}
    assert {k: v for k, v in got.items() if texts[k] is not None} == {k: v for k, v in texts.items() if v}
    assert got["nothing"] is None and got[""] is None


def test_sections_of_notes(spark):
    from lexloom.functions import identifiers

    notes = {"ändr. 3, 5 §§": ["3", "5"], "ny 2 kap. 7 a §": ["2:7 a"], "upph. 4–6 §§ och 9 §": ["4", "5", "6", "9"], "omtryck": [], None: []}
    got = {r["n"]: r["s"] for r in spark.createDataFrame([(x,) for x in notes], "n string").select("n", identifiers.affected_sections(F.col("n")).alias("s")).collect()}
    assert got == notes


def test_runs_stop_after_failures_in_a_row(spark, tmp_path):
    def process(day, pending):
        if day.day > 11:
            raise ValueError("contract")
        return 1, {}, set()

    report = days.run(spark, days.State(f"file://{tmp_path}/s", cursor=date(2024, 1, 10)), date(2024, 1, 20), process, most_failures=3, since=date(2024, 1, 11))
    assert len(report.days) == 4 and len(report.put_off) == 6 and report.put_off[0] == date(2024, 1, 15)


def test_queues_are_worked_off():
    clock = iter(range(100))
    assert days.worked_off(list("abcdef"), lambda own: {x: "busy" for x in own if x in "b"} if "b" in own and "a" in own else {}, 2, lambda: next(clock), 50) == (["a", "c", "d", "e", "f", "b"], [])
    clock = iter(range(100))
    assert days.worked_off(list("abcdef"), lambda own: {}, 2, lambda: next(clock), 2) == (["a", "b"], ["c", "d", "e", "f"])
    clock = iter(range(100))
    assert days.worked_off(list("abcd"), lambda own: {x: "no" for x in own} if "c" in own else {}, 2, lambda: next(clock), 50) == (["a", "b"], ["c", "d"])
    with pytest.raises(RuntimeError, match="busy"):
        days.worked_off(["a"], lambda own: {"a": "busy"}, 2, lambda: 0, 1)


def test_tables_in_tables_and_cells():
    from lexloom.functions import markup

    html = '<div><table><caption>Cap</caption><tr><td>a</td><td>b</td></tr></table><table class="x"><tr><td><table><tr><td onclick="y"><a href="javascript:z">in</a> <u>u</u></td></tr></table></td></tr></table></div>'
    flat, nested = markup.grids_of(html, cell=str.upper)
    assert flat.startswith("Cap\n\n") and "| A | B |" in flat
    assert nested == "<table><tr><td><table><tr><td><a>in</a>u</td></tr></table></td></tr></table>"


def test_long_runs_go_on_where_they_stopped(spark, tmp_path):
    from lexloom.orchestrate import Step, overnight

    done, path = [], f"file://{tmp_path}/record"

    def fails(times):
        left = [times]

        def do():
            left[0] -= 1
            if left[0] >= 0:
                raise OSError("no")
            done.append(times)
        return do

    steps = [Step("a", lambda: done.append("a")), Step("b", fails(1)), Step("c", fails(9), needed=False), Step("d", fails(9)), Step("e", lambda: done.append("e"))]
    assert overnight(spark, path, "r", steps, lambda: 0, 1) == [("a", "done"), ("b", "done"), ("c", "failed"), ("d", "failed"), ("e", "skipped")]
    steps[3] = Step("d", lambda: done.append("d"))
    assert overnight(spark, path, "r", steps, lambda: 0, 1) == [("a", "before"), ("b", "before"), ("c", "failed"), ("d", "done"), ("e", "done")]
    assert done == ["a", 1, "d", "e"] and overnight(spark, path, "s", steps[:1], lambda: 2, 1) == [("a", "late")]


def test_folders_by_day(tmp_path):
    from lexloom.sources import connector

    (tmp_path / "a").mkdir()
    for day in ("2001-01-01", "2005-01-01"):
        (tmp_path / "a" / f"{day}.xml").write_text(day)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "metadata.json").write_text('{"x": 1}')
    with connector.connect({"path": str(tmp_path)}) as source:
        assert list(source.discover_all()) == ["a", "b"] and list(source.discover_daily(date(2005, 1, 1))) == ["a"]
        assert source.get_text("a") == b"2005-01-01" and source.get_metadata("b") == b'{"x": 1}' and json.loads(source.get_metadata("a"))["versions"] == ["2001-01-01", "2005-01-01"]
        source.set_as_of(date(2003, 1, 1))
        assert source.get_text("a") == b"2001-01-01"
        source.set_as_of(date(2000, 1, 1))
        for key in ("a", "b", "c"):
            with pytest.raises(http.Refused):
                source.get_text(key)


def test_web_connector_and_refusals(tmp_path):
    from lexloom.sources import connector

    answers = {"http://x/all": b"a b\nc", "http://x/2024-01-02": b"b", "http://x/t/a/2003-01-01": b"old", "http://x/m/a": b"{}"}

    def open_url(request, timeout):
        if request.full_url in answers:
            return _Answer(answers[request.full_url])
        raise _error(410, b"gone")

    options = {"connector": "web", "catalogue": "http://x/all", "daily": "http://x/{day}", "text": "http://x/t/{key}/{as_of}", "metadata": "http://x/m/{key}", "cache": str(tmp_path / "c"), "asof": "2003-01-01"}
    source = connector.connect(options)
    source.client = http.Client(rate=0, open_url=open_url)
    assert list(source.discover_all()) == ["a", "b", "c"] and list(source.discover_daily(date(2024, 1, 2))) == ["b"] and source.get_text("a") == b"old" and source.get_metadata("a") == b"{}"
    answers.clear()
    assert source.get_text("a") == b"old"
    with pytest.raises(http.Refused) as refused:
        source.get_text("b")
    assert not refused.value.transient


def test_refused_documents_are_rows(spark, tmp_path):
    from lexloom.sources import connector

    connector.register(spark)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "2005-01-01.xml").write_text("x")
    (tmp_path / "b").mkdir()
    got = {r["norm"]: r for r in spark.read.format("documents").options(path=str(tmp_path)).load().collect()}
    assert bytes(got["a"]["content"]) == b"x" and got["a"]["reason"] is None and got["b"]["content"] is None and got["b"]["status"] == 404
