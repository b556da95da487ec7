"""What op3_pii's terms cost as they are dealt."""

from gazetta.llm import common, pii


def test_terms_are_dealt_once_by_numbers(spark, monkeypatch):
    """A text's terms are joined with their counts once, by a number that stands for the text's digest."""
    tables, real = {}, common.saved
    monkeypatch.setattr(common, "saved", lambda df, label: tables.setdefault(label, real(df, label)))
    rows = [(1, "john a@b.com lives here"), (2, "john a@b.com lives here"), (3, "john x@y.org lives"), (4, "nobody lives here"), (5, None)]
    found = {r.doc_id: r.added for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert dict(tables["held"][0].dtypes)["key"] == dict(tables["pairs"][0].dtypes)["key"] == "bigint"
    assert sorted(found) == [1, 2, 3, 4, 5] and found[1] == found[2] and not found[4] and not found[5]
