import json
import random
import xml.etree.ElementTree as ET

from hypothesis import given, settings
from hypothesis import strategies as st

from colophon.operators import shred

tree = st.recursive(st.fixed_dictionaries({}, optional={"level": st.integers(0, 9), "schutte_nr": st.integers(1, 99)}), lambda kids: st.fixed_dictionaries({"item": st.lists(kids, max_size=4)}, optional={"level": st.integers(0, 9)}), max_leaves=20)


def walk(items, parent=0, out=None):
    """Brute force: numbers by recursion."""
    out = [] if out is None else out
    for it in items:
        seq = len(out) + 1
        out.append((seq, parent, it.get("level", -1), it.get("schutte_nr", 0)))
        walk(it.get("item", []), seq, out)
    return out


def table(doc):
    return list(zip(*shred.table_rows(doc, "links")))


def to_xml(items):
    out = []
    for it in items:
        attrs = "".join(f' {k}="{v}"' for k, v in it.items() if k != "item")
        out.append(f"<item{attrs}><title>t &amp; u</title><!-- <item level='9'/> -->{to_xml(it.get('item', []))}</item>")
    return "".join(out)


@settings(max_examples=150, deadline=None)
@given(st.lists(tree, max_size=4))
def test_json_and_xml_match_recursion(items):
    want = walk(items)
    assert table(shred.shred_json(json.dumps({"toc": {"item": items}}))) == want
    xml = f"<toc>{to_xml(items)}</toc>"
    assert table(shred.shred_xml(xml)) == want
    assert len(want) == sum(1 for e in ET.fromstring(xml).iter("item"))


full = st.recursive(
    st.fixed_dictionaries({}, optional={"title": st.text("ab ", max_size=3), "page": st.lists(st.fixed_dictionaries({}, optional={"number": st.integers(0, 9), "source": st.integers(0, 9)}), max_size=3), "schuttenummers": st.lists(st.integers(1, 9), max_size=3)}),
    lambda kids: st.fixed_dictionaries({"item": st.lists(kids, max_size=4)}, optional={"page": st.lists(st.fixed_dictionaries({"number": st.integers(0, 9)}), max_size=2), "schuttenummers": st.integers(1, 9)}), max_leaves=15,
)


@settings(max_examples=150, deadline=None)
@given(st.lists(full, max_size=4))
def test_every_table_comes_from_levels_alone(items):
    doc = shred.shred_json(json.dumps({"toc": {"item": items}}))
    # nothing of the parser is left but levels and the values that are present
    doc = {leaf: (c.rep, c.defined, c.values) for leaf, c in doc.items()}
    back = {}
    for leaf, (rep, defined, values) in doc.items():
        back[leaf] = shred.Column()
        back[leaf].rep, back[leaf].defined, back[leaf].values = list(rep), list(defined), [v for v in values]
        assert None not in values and (not rep or rep[0] == 0)
    pages, numbers, titles, seq = [], [], [], 0

    def walk_all(nodes):
        nonlocal seq
        for it in nodes:
            seq += 1
            own = seq
            titles.append(it.get("title"))
            pages.extend((own, k, *(str(p[x]) if x in p else None for x in ("number", "source"))) for k, p in enumerate(it.get("page", []), 1))
            many = it.get("schuttenummers", [])
            numbers.extend((own, k, str(n)) for k, n in enumerate(many if isinstance(many, list) else [many], 1))
            walk_all(it.get("item", []))

    walk_all(items)
    assert list(zip(*shred.table_rows(back, "pages"))) == pages
    assert list(zip(*shred.table_rows(back, "numbers"))) == numbers
    wide = dict(zip((n for n, _ in shred.TABLES["items"]), shred.table_rows(back, "items")))
    assert wide["title"] == titles and sum(wide["n_pages"]) == len(pages) and sum(wide["n_numbers"]) == len(numbers)


def test_all_pages_and_numbers_are_kept(spark):
    xml = "<toc><item schuttenummers='1, 2 7-9'><page number='3' source='4'/><title>a</title><page number='5'/><item><page source='6'/></item></item></toc>"
    other = '{"toc": {"item": {"page": [7, {"number": 8}, null], "schuttenummers": [1, "2 3"]}}}'
    df = spark.createDataFrame([(1, "xml", xml), (2, "json", other), (2, "json", other)], "toc_id bigint, item_format string, item string")
    assert sorted((tuple(r) for r in shred.shred_table(df, "pages").collect()), key=repr) == [(1, 1, 1, "3", "4"), (1, 1, 2, "5", None), (1, 2, 1, None, "6"), (2, 1, 1, "7", None), (2, 1, 2, "8", None)]
    assert sorted(tuple(r) for r in shred.shred_table(df, "numbers").collect()) == [(1, 1, 1, "1"), (1, 1, 2, "2"), (1, 1, 3, "7-9"), (2, 1, 1, "1"), (2, 1, 2, "2"), (2, 1, 3, "3")]


def test_deliveries_that_differ_are_not_mixed(spark):
    docs = ["<toc><item level='1'><item level='2'/></item></toc>", "<toc><item level='5'/><item level='6'/><item level='7'/></toc>"]
    df = spark.createDataFrame([(1, "xml", d) for d in docs * 2] + [(None, "xml", docs[0])], "toc_id bigint, item_format string, item string")
    got = sorted((tuple(r) for r in shred.shred_items(df).collect()), key=repr)
    assert [r[1:] for r in got if r[0] is None] == [(1, 0, 1, 0), (2, 1, 2, 0)]
    assert [r[1:] for r in got if r[0] == 1] in ([(1, 0, 1, 0), (2, 1, 2, 0)], [(1, 0, 5, 0), (2, 0, 6, 0), (3, 0, 7, 0)])


def test_single_values_stand_for_lists_and_objects():
    doc = shred.shred_json('{"toc": {"item": {"title": {"text": "a", "lang": "nl"}, "page": 7, "item": ["b", null, {"level": " 2 ", "schutte_nr": "3bis"}]}}}')
    assert table(doc) == [(1, 0, -1, 0), (2, 1, -1, 0), (3, 1, 2, 0)]
    wide = dict(zip((n for n, _ in shred.TABLES["items"]), shred.table_rows(doc, "items")))
    assert wide["title"] == ["a", "b", None] and wide["page_number"] == ["7", None, None]


def test_damaged_documents_have_no_rows():
    for text, kind in ((None, "xml"), ("", "xml"), ("  ", "json"), ("<toc><item></toc>", "xml"), ("<toc><item/>", "xml"), ('{"toc": {"item": [{}', "json"), ("NaN", "json"), ('{"toc": NaN}', "json"), ("<toc/><toc/>", "xml")):
        doc = shred.shred(text, kind)
        assert doc is None or not doc["level"].rep


def test_very_deep_documents():
    n = 40_000
    doc = shred.shred_json('{"toc": ' + '{"item": ' * n + "null" + "}" * n + "}")
    depth, _ = shred.single_values(doc["level"])
    assert depth.tolist() == list(range(1, n))
    assert shred.parents(depth).tolist() == list(range(n - 1))
    deep = shred.shred_xml("<toc>" + "<item>" * n + "</item>" * n + "</toc>")
    assert shred.single_values(deep["title"])[0].tolist() == list(range(1, n + 1))


def test_deep_parser_equals_the_library():
    rng = random.Random(3)

    def value(d):
        k = rng.randrange(8 if d < 4 else 5)
        if k == 5:
            return [value(d + 1) for _ in range(rng.randrange(4))]
        if k == 6:
            return {str(i): value(d + 1) for i in range(rng.randrange(4))}
        return {} if k == 7 else [None, True, -1.5e3, "x\"\\é", 12][k]

    for _ in range(200):
        v = value(0)
        for text in (json.dumps(v), json.dumps(v, indent=1)):
            assert shred._parse_deep(text) == v
    for bad in ("[1,]", "{", '{"a" 1}', "[1 2]", "tru", "1 2", ""):
        try:
            shred._parse_deep(bad)
            raise AssertionError(bad)
        except ValueError:
            pass


def test_redeliveries_and_extra_columns(spark):
    rows = [(1, "xml", "<toc><item level='1'/></toc>", "x"), (1, "xml", "<toc><item level='1'/></toc>", "x"), (2, None, '{"toc":{"item":[{},{}]}}', "y"), (3, "json", None, None)]
    df = spark.createDataFrame(rows, "toc_id bigint, item_format string, item string, level string")
    got = sorted(tuple(r) for r in shred.shred_items(df).collect())
    assert got == [(1, 1, 0, 1, 0), (2, 1, 0, -1, 0), (2, 2, 0, -1, 0)]
    assert shred.shred_items(df.limit(0)).count() == 0
