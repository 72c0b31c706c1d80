"""HTML table extraction: parser records and the relational steps."""

from ratebridge.sources import html_tables as H

PLAIN = """<html><body>
<table><tr><td>Öppettider</td><td>9-17</td></tr></table>
<table><caption>Våra LISTRÄNTOR</caption>
<tr><th>Bindningstid</th><th>Ränta</th><th>Ändring</th><th>Gäller från</th></tr>
<tr><td>3 mån</td><td>4,25&nbsp;%</td><td>-</td><td>2024-05-02</td></tr>
<tr><td>1 år</td><td>4,10 %</td><td>-</td><td></td></tr>
<tr><td>only one cell</td></tr>
<tr><td>6 mån</td><td>4,00 %</td><td>-</td><td>2024-06-01</td></tr>
<tr><td>2 år</td><td>-</td><td>-</td><td></td></tr>
<tr><td>3 år</td><td>3,9 %</td></tr>
</table></body></html>"""

NO_CAPTION = """<table><tr><td>a</td><td>b</td></tr></table>
<table><tr><th>x</th></tr><tr><td>5 år</td><td>3,5 %</td></tr></table>"""

SECTIONED = """<table><caption>Aktuella bolåneräntor</caption>
<thead><tr><th>Bindningstid</th><th>Snitt<b>ränta</b> april</th><th>Listränta från 5 maj 2024</th></tr></thead>
<tbody><tr><td>3 mån</td><td>3,95 %</td><td>4,25 <span>%</span></td></tr>
<tr><td>10 år</td><td></td><td>3,80 %</td></tr>
<tr><td>x</td></tr></tbody></table>"""

NO_THEAD = """<table><caption>bolåneräntor</caption><tbody><tr><td>3 mån</td><td>4 %</td></tr></tbody></table>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, bank string, fetched_at string, html string")


def test_parser_records():
    (table,) = H.parse_tables(SECTIONED)
    assert table["caption"] == "Aktuella bolåneräntor" and "4,25 %" in table["text"]
    assert table["heads"] == ["Bindningstid", "Snitträntaapril", "Listränta från 5 maj 2024"]
    rows = [r for r in table["rows"] if r["section"] == "tbody"]
    assert rows[0]["cells"] == ["3 mån", "3,95 %", "4,25%"] and rows[0]["cells_spaced"] == ["3 mån", "3,95 %", "4,25 %"]
    assert H.parse_tables("") == [] and H.parse_tables("<p>no tables</p>") == [] and H.parse_tables(None) == []


def test_nested_and_unclosed_tables():
    outer, inner = H.parse_tables("<table><caption>a</caption><caption>b</caption><tr><td>1<table><tr><td>2 %</table><td>3</tr><tr><td>4")
    assert outer["caption"] == "a" and [r["cells"] for r in outer["rows"]] == [["1", "3"], ["4"]] and "%" not in outer["text"]
    assert [r["cells"] for r in inner["rows"]] == [["2 %"]] and inner["heads"] is None and inner["caption"] is None


def test_percent_outside_cells_chooses_a_table(spark):
    html = """<table><tr><td>a</td><td>b</td></tr></table><table>Ränta i %<tr><th>x</th></tr><tr><td>5 år</td><td>3,5</td></tr></table>
    <table><tr><td>h</td></tr><tr><td>1 år</td><td>9 %</td></tr></table>"""
    df = pages(spark, [(1, "Nordea", "T", html), (2, "Nordea", "T", "<table><script>var p = '%';</script><tr><td>1 år</td><td>1</td></tr></table>")])
    assert [(r.period_label, r.list_rate) for r in H.extract_bank_pages(df).collect()] == [("5Y", 3.5)]


def test_pages_are_not_shuffled_and_leave_in_batches(spark, monkeypatch):
    from ratebridge.sources import html_parse

    df = pages(spark, [(i, "Nordea", f"T{i}", PLAIN) for i in range(40)]).coalesce(1)
    plan = H.extract_bank_pages(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    monkeypatch.setattr(html_parse, "FLUSH_AT", 2000)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"page_id": list(range(40)), "html": [PLAIN] * 40})
    out = list(html_parse.pages_fn(1)([batch]))
    assert len(out) >= 10 and [i for b in out for i in b.column(0).to_pylist()] == list(range(40))


def test_plain_table_caption_fallback_skips_and_ffill(spark):
    df = pages(spark, [(1, "Nordea", "T1", PLAIN), (2, "Nordea", "T2", NO_CAPTION), (3, "Nordea", "T3", "")])
    out = sorted((tuple(r) for r in H.extract_bank_pages(df).collect()), key=lambda t: (t[6], t[1]))
    assert out == [
        ("Nordea", "1Y", 1.0, 4.1, None, "2024-05-02", "T1", "nordea_html"),
        ("Nordea", "3M", 0.25, 4.25, None, "2024-05-02", "T1", "nordea_html"),
        ("Nordea", "3Y", 3.0, 3.9, None, "2024-06-01", "T1", "nordea_html"),   # 6M row updated valid-from
        ("Nordea", "5Y", 5.0, 3.5, None, "", "T2", "nordea_html"),
    ]


def test_sectioned_table_headers(spark):
    df = pages(spark, [(1, "Swedbank", "T", SECTIONED), (2, "Swedbank", "T", NO_THEAD)])
    out = sorted((tuple(r) for r in H.extract_bank_pages(df).collect()), key=lambda t: (t[6], t[1]))
    assert out == [
        ("Swedbank", "10Y", 10.0, 3.8, None, "5 maj 2024", "T", "swedbank_html"),
        ("Swedbank", "3M", 0.25, 4.25, 3.95, "5 maj 2024", "T", "swedbank_html"),
    ]
