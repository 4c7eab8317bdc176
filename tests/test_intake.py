"""Ways of listing, XML that is read as it arrives, words of PDF documents."""

from __future__ import annotations

import io
from datetime import date

import pytest

from lexloom.sources import paging, pdf, streams


def test_shifting_offsets_repeat_nothing():
    pages = {0: [1, 2, 3], 3: [3, 4, 5], 6: [5, 6], 9: []}
    assert list(paging.offsets(lambda at, n: pages[at], 3)) == [1, 2, 3, 4, 5, 6]


def test_groups_are_whole():
    rows = [("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2), ("c", 3), ("d", 1)]
    ask = lambda key, n: [r for r in rows if key is None or r[0] >= key][:n]
    assert list(paging.whole_groups(ask, 4, lambda r: r[0])) == [rows[:2], rows[2:3], rows[3:6], rows[6:]]
    with pytest.raises(ValueError, match="fills a page"):
        list(paging.whole_groups(ask, 2, lambda r: r[0]))


def test_numbered_pages_end_without_new_rows():
    asked = []
    assert list(paging.numbered(lambda p: asked.append(p) or [min(p, 4)], without_new=3)) == [1, 2, 3, 4] and asked == list(range(1, 8))


def test_short_answers_are_told():
    assert list(paging.counted(lambda at, n: (5, list(range(at, min(at + n, 5)))), 2)) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="empty page"):
        list(paging.counted(lambda at, n: (5, [1, 2] if at == 0 else []), 2))
    with pytest.raises(ValueError, match="page 1 came for page 2"):
        list(paging.back_to(lambda p: (1, [date(2024, 1, 9)]), date(2024, 1, 1), lambda d: d))


def test_logs_are_read_back_to_a_day():
    pages = {1: [date(2024, 1, 9), date(2024, 1, 8)], 2: [date(2024, 1, 7), date(2024, 1, 2)], 3: [date(2023, 1, 1)]}
    assert list(paging.back_to(lambda p: (p, pages[p]), date(2024, 1, 5), lambda d: d)) == [date(2024, 1, 9), date(2024, 1, 8), date(2024, 1, 7)]


def test_sitemaps_and_feeds():
    maps = {"i": "<sitemapindex><loc>a</loc><loc>gone</loc><loc> b </loc></sitemapindex>", "a": "<urlset><loc>x/1</loc><loc>y/2</loc></urlset>", "b": "<urlset><loc>x/3</loc></urlset>"}
    assert list(paging.sitemap(maps.get, "i", "^x/")) == ["x/1", "x/3"]
    loop = {"u": '<feed><entry><id>1</id></entry><link rel="next" href="v"/></feed>', "v": '<feed><entry><id>2</id></entry><link rel="next" href="u"/></feed>'}
    assert [x.text() for x in paging.feed(loop.get, "u")] == ["1", "2"]


def test_known_days_are_not_asked_again():
    asked = []
    got = paging.calendar(lambda d: asked.append(d) or [d.day], date(2024, 1, 1), date(2024, 1, 6), {date(2024, 1, n): [0] for n in range(1, 7)}, again=2)
    assert asked == [date(2024, 1, 5), date(2024, 1, 6)] and got[date(2024, 1, 1)] == [0] and len(got) == 6


def test_years_of_numbers():
    marks = [(100, 1950), (300, 1960), (400, 1990)]
    assert paging.year_of(200, marks) == 1955 and paging.year_of(350, marks) == 1975 and paging.year_of(5, marks) == 1950 and paging.year_of(900, marks) == 1990
    assert paging.candidates(200, marks, last=1956) == [1956, 1955, 1954, 1953, 1957] and paging.candidates(200, marks, reach=0) == [1955]


class _Counting(io.BytesIO):
    def __init__(self, data):
        super().__init__(data)
        self.count = 0

    def read(self, n=-1):
        got = super().read(n)
        self.count += len(got)
        return got


def test_headers_are_read_no_further():
    head = b"<akt xmlns='u'><meta><liik>seadus</liik><algus>2020-01-02</algus></meta><sisu><p>liik</p>"
    stream = _Counting(head + b"<p>x</p>" * 500_000 + b"</sisu></akt>")
    assert streams.header(stream, ("liik", "algus", "lopp"), "sisu") == {"liik": "seadus", "algus": "2020-01-02"}
    assert stream.count <= 2 * streams.CHUNK
    assert streams.header(io.BytesIO(b"<a><liik>x</liik><<"), ("liik",), "z") == {"liik": "x"} and streams.header(io.BytesIO(b""), ("a",), "z") == {}


def test_records_stream():
    data = b"<es>" + b"".join(b"<e id='%d'><t> n %d </t><i d='1'/><i d='2'/></e>" % (i, i) for i in range(5000)) + b"<e id='x'><t"
    got = list(streams.records(io.BytesIO(data), "e"))
    assert len(got) == 5000 and got[7] == {"id": "7", "t": "n 7", "i@d": "1"}
    assert list(streams.records(io.BytesIO(b""), "e")) == []


def test_words_of_pages():
    raw = pdf.written([[(72, 700, 12, "Two words"), (72, 680, 9, "a (b) \\ c")], [], [(10, 10, 8, "last")]])
    words = list(pdf.Document(raw).words())
    assert [(w.page, w.y, w.size, w.text) for w in words] == [(1, 700, 12, "Two"), (1, 700, 12, "words"), (1, 680, 9, "a"), (1, 680, 9, "(b)"), (1, 680, 9, "\\"), (1, 680, 9, "c"), (3, 10, 8, "last")]
    assert words[0].x < words[1].x
    assert [r[-1] for r in pdf.PdfWords.func().eval(b"%PDF /Encrypt")] == ["encrypted"] and [r[-1] for r in pdf.PdfWords.func().eval(None)] == ["no words"]


def test_codes_by_their_font_and_spaces_by_kerning():
    content = b"BT /F1 10 Tf 14 TL 5 50 Td [<0001> 20 <0002> -500 <0003>] TJ T* <00010003> Tj ET"
    font = {-1: "2", 1: "Α", 2: "β", 3: "γ"}
    assert [(w.text, w.y) for w in pdf._shown(content, 1, {b"F1": font})] == [("Αβ", 50), ("γ", 50), ("Αγ", 36)]
    cmap = b"<< /ToUnicode 9 0 R >>"
    doc = pdf.Document(b"8 0 obj\n" + cmap + b"\nendobj\n9 0 obj\n<< >>\nstream\n1 beginbfchar <0001> <0391> endbfchar 1 beginbfrange <0005> <0007> <0041> endbfrange\nendstream\nendobj\n")
    assert doc._unicode(8) == {-1: "2", 1: "Α", 5: "A", 6: "B", 7: "C"}
