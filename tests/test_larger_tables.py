"""Queries on rows that the smallest tables do not have."""

from __future__ import annotations

import pytest

from lexloom.plans.catalogue import ORACLES, QUERIES
from lexloom.plans import aggregate, layouts as plans  # noqa: F401 - they register their queries
from lexloom.sources import layouts
from lexloom.sources.layout_table import LAYOUTS, SAMPLES
from tests.compare import connect, same


def test_lengths_are_rounded_as_in_sql(spark, tmp_path):
    texts = ["aaaaaaaaaaaa1bbb", "aaaaaaaaaaaaa1bb", "aaaaaa\nb", "a" * 13 + '"', "x. y. z", "1"]  # 0.8 of 16: 12.8, of 8: 6.4, of 14: 11.2, of 7: 5.6
    spark.createDataFrame([(4 * i + 3, "en", x) for i, x in enumerate(texts)], "doc_id bigint, lang string, text string").coalesce(1).write.parquet(f"{tmp_path}/documents")
    next(tmp_path.glob("documents/part-*.parquet")).rename(tmp_path / "documents.parquet")
    same(QUERIES["fidelity_report"](spark, str(tmp_path)), connect(str(tmp_path)), ORACLES["fidelity_report"])


def tolerant(text):
    builder = layouts._Builder(False)
    builder.feed(text)
    builder.close()
    return builder.root


def shape(node):
    """A tree with neighbouring pieces of text joined."""
    items = []
    for x in node.items:
        if isinstance(x, str) and items and isinstance(items[-1], str):
            items[-1] += x
        else:
            items.append(x if isinstance(x, str) else shape(x))
    return node.tag, node.attrs, items


ODD = ["", "x", "<a/>", " \n<a b='1'>x</a>\n ", "<a>&amp;lt;</a>", "<a b='x&quot;'>t</a>", '<?xml version="1.0" encoding="UTF-8"?>\n<a:B xmlns:a="u" a:C="D">é<br/>z</a:B>\n', '<?xml version="1.0" encoding="iso-8859-1"?><a>é</a>',
       "<a><!-- c --><![CDATA[<b>]]></a>", "<a>&#128;</a>", "<a b='1\n2'>x</a>", "<a\n b='1'\tc='2'>x\r\ny</a>", "<_a>x</_a>", "<a B='1' b='2'/>", "<!DOCTYPE a [<!ENTITY q 'z'>]><a>&q;</a>", "<a>x</a>junk", "<a><b></a>"]


@pytest.mark.parametrize("text", ODD + [SAMPLES[x].text for x in LAYOUTS if LAYOUTS[x].form == "xml"])
def test_well_formed_xml_is_read_as_before(text):
    assert shape(layouts.tree(text, "xml")[0]) == shape(tolerant(text))


@pytest.mark.parametrize("code", ["ch", "lu", "nl"])
def test_samples_are_read_the_short_way(code):
    assert layouts._well_formed(SAMPLES[code].text) is not None


def test_nodes_by_name_keep_their_order_and_place():
    root = layouts.tree("<r><a n='1'><b n='2'/><a n='3'><b n='4'/></a></a><b n='5'/></r>", "xml")[0]
    assert [x.attrs["n"] for x in layouts.find(root, "a/b")] == ["2", "4", "4"] and [x.attrs["n"] for x in layouts.find(root, "b")] == ["2", "4", "5"]


def test_documents_of_a_small_file_are_dealt_to_all_cores(spark):
    assert plans.documents(spark, "/root/testdata/sf0.001", "nl").rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
