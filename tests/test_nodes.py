from lexweave.functions import html
from lexweave.operators import nodes

PAGE = (
    "<p>Table 1. Things</p><table><tr><th>A<th>B<tr><td>1<td>2<tr><td><td></table><p>* a footnote</p><p>plain</p><img src=x><p>Fig. 2 after</p>"
    "<ul><li>(i) one<li>(ii) two<li>(v) five</ul><ul><li>h) x<li>i) y</ul><ul><li>none</ul><ol><li>1. a<li>2. b</ol>"
)


def test_roles(spark):
    n = html.node_table(spark.createDataFrame([("p", PAGE)], "page string, html string"), "page", "html").cache()
    at = {r.ordinal: r for r in n.collect()}
    caps = {r.text: at[r.caption_of].kind for r in nodes.captions(n, "page").where("caption_of is not null").collect()}
    assert caps == {"Table 1. Things": "table", "Fig. 2 after": "image"}
    fam = [(r.marker, r.family) for r in nodes.list_families(n, "page").where("kind = 'list_item'").orderBy("ordinal").collect()]
    assert fam == [("i", "lower_roman"), ("ii", "lower_roman"), ("v", "lower_roman"), ("h", "lower_alpha"), ("i", "lower_alpha"), (None, "unordered"), ("1", "arabic"), ("2", "arabic")]
    assert [(r.place, r.n_cells, r.role) for r in nodes.table_roles(n, "page").orderBy("row").collect()] == [(1, 2, "header"), (2, 2, "body"), (3, 2, "empty")]
    assert [(at[r.table].kind, r["mark"]) for r in nodes.footnotes(n, "page").collect()] == [("table", "*")]
