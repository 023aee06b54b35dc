"""Nested documents: typed columns, rescued fields, malformed texts."""

from strata.sources.documents import flatten, malformed, read_documents


def test_flatten_rescue_and_report(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n'.join([
        '{"id": 1, "goals": [{"minute": 5, "who": "A"}, {"minute": "late", "who": "B", "var": {"x": [1]}}, {"who": null}]}',
        '{"id": 2}', '{"id": 3, "goals": {"minute": 1}}', '{"id": 4, "goals": [', '', '[1]', '{"id": 5, "goals": [7, null, "t"]}']))
    docs = read_documents(spark, str(tmp_path))
    assert [r.text for r in malformed(docs).collect()] == ['{"id": 4, "goals": [']
    rows = flatten(docs, "$.goals", {"minute": "int", "who": "string"}, {"id": ("$.id", "long")}).orderBy("id", "position").collect()
    assert [tuple(r) for r in rows] == [
        (1, 0, 5, "A", None), (1, 1, None, "B", {"minute": "late", "var": '{"x":[1]}'}), (1, 2, None, None, None),
        (5, 0, None, None, {"$": "7"}), (5, 1, None, None, None), (5, 2, None, None, {"$": '"t"'})]
    assert flatten(docs.limit(0), "$.goals", {"minute": "int"}).count() == 0


def test_whole_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"t":\n [{"y": 1},\n  {"y": 2}]}')
    docs = read_documents(spark, str(tmp_path), whole_files=True)
    assert sorted(r.y for r in flatten(docs, "$.t", {"y": "long"}).collect()) == [1, 2]
