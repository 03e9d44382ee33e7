"""Rules, boundaries and quirks of the operators on inline rows."""

from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.functions import provider, text
from pagewright.operators import chunk, flatten, gate, route, sections, verify, vision
from pagewright.options import Options, artifact_stem, options_from, read_env
from pagewright.sources import files
from pagewright.streaming import ingest

SIGNALS = "doc_id long, page_num int, char_count int, image_count int, image_coverage double, drawing_count int"



@pytest.mark.parametrize(
    "signal, mode, reason",
    [
        ((0, 0, 0.0, 250), "vlm", "vector_only_no_native_text"),
        ((0, 1, 0.0, 0), "ocr", "no_native_text_with_image"),
        ((29, 1, 0.03, 0), "ocr", "low_text_with_image"),
        ((29, 1, 0.029, 0), "native", "native_text_available"),
        ((149, 1, 0.5, 0), "ocr", "image_dominant_low_text"),
        ((0, 0, 0.0, 199), "native", "native_text_available"),
    ],
)
def test_routes(spark, signal, mode, reason):
    row = route.route_vlm(spark.createDataFrame([(1, 7, *signal)], SIGNALS)).first()
    assert (row.mode, row.reason) == (mode, reason)
    assert row.vlm_candidate == (signal[3] >= 20 or signal[2] >= 0.5)


def test_vector_page_reasons(spark):
    assert route.route_vlm(spark.createDataFrame([(1, 7, 0, 0, 0.0, 250)], SIGNALS)).first().vlm_candidate_reasons == ["vector_only_no_native_text", "drawing_dominant_low_text"]


def test_ranges_break_at_gaps_and_modes(spark):
    pages = spark.createDataFrame([(1, 1, "ocr"), (1, 2, "vlm"), (1, 3, "native"), (1, 4, "native"), (1, 6, "native")], "doc_id long, page_num int, mode string")
    assert sorted((r.mode, r.start_page, r.end_page, r.page_count) for r in route.page_ranges(pages).collect()) == [("native", 3, 4, 2), ("native", 6, 6, 1), ("ocr", 1, 1, 1), ("vlm", 2, 2, 1)]
    items = route.work_items(pages, Options(progress_mode="range")).collect()
    assert "vlm" not in {r.mode for r in items} and len(items) == 3
    assert {r.page_count for r in route.work_items(pages).collect()} == {1}


def test_page_range_is_checked(spark):
    with pytest.raises(ValueError):
        route.requested_pages(spark.createDataFrame([], SIGNALS), 0, 3)
    with pytest.raises(ValueError):
        Options(vlm_only=True).check()
    with pytest.raises(ValueError):
        Options(forced_pages=(9,)).check(1, 5)


ROUTED = "doc_id long, page_num int, initial_route string, mode string, char_count int, vlm_candidate boolean, vlm_candidate_reasons array<string>"
STATS = "doc_id long, page_num int, text_chars long, text_element_count long, table_count long, picture_count long"


@pytest.mark.parametrize(
    "mode, chars, candidate, stats, decision, reasons",
    [
        ("native", 20, True, (12, 1, 0, 1), "fallback_to_vlm", ["visual_risk_with_sparse_extraction"]),
        ("native", 400, False, (400, 8, 0, 0), "accept", []),
        ("ocr", 0, False, (0, 0, 0, 2), "fallback_to_vlm", ["no_docling_content", "ocr_produced_no_text"]),
    ],
)
def test_verifier(spark, mode, chars, candidate, stats, decision, reasons):
    page = spark.createDataFrame([(1, 1, mode, mode, chars, candidate, [])], ROUTED)
    row = verify.verify_pages(page, spark.createDataFrame([(1, 1, *stats)], STATS)).first()
    assert (row.decision, row.reasons, row.accepted, row.confidence) == (decision, reasons, decision == "accept", 0.95 if decision == "accept" else 0.0)


def test_forcing_and_budget(spark):
    pages = spark.createDataFrame([(1, p, m, m, 400, False, ["vector_only_no_native_text"] if m == "vlm" else []) for p, m in ((1, "vlm"), (2, "native"), (3, "native"))], ROUTED)
    stats = spark.createDataFrame([(1, p, 400, 8, 0, 0) for p in (1, 2, 3)], STATS)
    options = Options(provider="local", forced_pages=(1, 2), max_vlm_pages=1)
    decided = verify.verify_pages(pages, stats, options)
    rows = {r.page_num: r for r in decided.collect()}
    assert rows[1].reasons == ["vector_only_no_native_text"] and rows[2].reasons == ["forced_vlm_page"] and rows[3].accepted
    after = {r.page_num: r for r in verify.budget_fallback(decided, options).collect()}
    assert after[1].decision == "fallback_to_vlm" and after[2].decision == "manual_review" and after[2].reasons[-1] == "max_vlm_pages_exceeded"
    without = {r.page_num: r for r in verify.budget_fallback(decided, Options(forced_pages=(1, 2))).collect()}
    assert without[1].final_route == without[2].final_route == "manual_review" and without[2].reasons == ["forced_vlm_page"]
    assert all(r.decision != "manual_review" for r in verify.budget_fallback(decided, Options(provider="local", max_vlm_pages=0)).collect())


def test_text_functions(spark):
    row = spark.createDataFrame([(" A  b\n", "MCMXC", "XIV", "12A")], "t string, a string, b string, c string").select(text.normalize_text("t").alias("t"), text.roman_to_int("a").alias("a"), text.roman_to_int("b").alias("b"), text.roman_to_int("c").alias("c"), text.slugify(F.lit("__Été & Co. " + "x" * 60)).alias("s"), text.slugify(F.lit("§§")).alias("u"), text.progress_bar(F.lit(15), F.lit(30), F.lit("Page 15 complete")).alias("p")).first()
    assert (row.t, row.a, row.b, row.c, row.u) == ("A b", 1990, 14, None, "untitled")
    assert len(row.s) == 48 and row.s.startswith("t_co_x")
    assert row.p == "[##############--------------]  50.0% (15/30) Page 15 complete"


def test_provider_functions(spark):
    urls = spark.createDataFrame([("http://gateway:7080/v1",), ("http://gateway:7080/v1/v1/",), ("http://gateway:7080",)], "u string")
    assert {r.x for r in urls.select(provider.normalize_base_url("u").alias("x")).collect()} == {"http://gateway:7080/v1"}
    assert "authentication failed" in spark.range(1).select(provider.status_message(F.lit(401)).alias("x")).first().x


class Scripted:
    """A provider that answers from a list and keeps what it was asked."""

    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def chat(self, payload):
        self.asked.append(payload)
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return {"choices": [{"finish_reason": "stop", "message": {"content": answer}}], "usage": {"completion_tokens": 2}, "elapsed_seconds": 0.5}


GOOD = json.dumps({"summary": "Page.", "elements": [{"type": "paragraph", "text": "Text.", "confidence": 0.9}], "unresolved_visuals": []})


@pytest.mark.parametrize("first", ["<think>unfinished", "", "not json"])
def test_local_retry_once(first):
    p = Scripted(first, GOOD)
    reply, _ = vision.extract_page(p, Options(provider="local"), 3, b"x")
    assert reply["summary"] == "Page." and [a["max_tokens"] for a in p.asked] == [2600, 5000]
    assert "response_format" not in p.asked[0]


def test_no_retry_of_requests_or_hosted():
    with pytest.raises(vision.ProviderError, match="gone"):
        vision.extract_page(p := Scripted(vision.ProviderError("gone"), GOOD), Options(provider="local"), 1, b"")
    assert len(p.asked) == 1
    with pytest.raises(vision.ProviderError, match="valid JSON"):
        vision.extract_page(p := Scripted("no", GOOD), Options(provider="openai"), 1, b"")
    assert p.asked[0]["response_format"]["json_schema"]["strict"] and p.asked[0]["max_completion_tokens"] == 2600
    with pytest.raises(vision.ProviderError, match="after retry"):
        vision.extract_page(Scripted("no", "no"), Options(provider="local"), 1, b"")


@pytest.mark.parametrize("content", [GOOD, f"<think>maybe {{x}}</think>\n{GOOD}", f"```json\n{GOOD}\n```"])
def test_json_recovery(content):
    assert vision.checked(vision.recover_json(content))["summary"] == "Page."


@pytest.mark.parametrize("element, error", [({"type": "poem", "text": "", "confidence": 1}, "unsupported"), ({"type": "table", "confidence": 1}, "without text"), ({"type": "table", "text": "", "confidence": 2}, "confidence"), ({"type": "table", "text": "", "confidence": float("nan")}, "confidence")])
def test_reply_validation(element, error):
    with pytest.raises(vision.ProviderError, match=error):
        vision.checked({"elements": [element]})
    assert vision.checked({"elements": [{"type": "chart_description", "text": "", "confidence": 0}]})


def test_extract_pages_keeps_failures(spark):
    pages = spark.createDataFrame([(1, 1, bytearray(b"x")), (1, 2, None)], "doc_id long, page_num int, image binary")
    good = GOOD

    class Fixed:
        def chat(self, payload):
            if "page 2" in payload["messages"][0]["content"][0]["text"]:
                raise KeyError("boom")
            return {"choices": [{"message": {"content": good}}], "usage": {}, "elapsed_seconds": 1.0}

    rows = {r.page_num: r for r in vision.extract_pages(pages, Fixed, Options(provider="local")).collect()}
    assert rows[1].elements[0].text == "Text." and rows[2].error == "unexpected failure: KeyError"


LAYOUT = {
    "body": {"children": [{"$ref": "#/groups/0"}, {"$ref": "#/tables/0"}, "#/texts/3", {"$ref": "#/nowhere/1"}, {"$ref": "#/pictures/0"}]},
    "groups": [{"self_ref": "#/groups/0", "label": "list", "children": [{"$ref": "#/texts/0"}, {"$ref": "#/groups/1"}]}, {"self_ref": "#/groups/1", "name": "inner", "children": [{"$ref": "#/texts/1"}]}],
    "texts": [
        {"self_ref": "#/texts/0", "label": "section_header", "parent": {"$ref": "#/groups/0"}, "text": "1.  First", "prov": [{"page_no": 2, "bbox": {"l": 1, "t": 2, "r": 3, "b": 4, "coord_origin": "TOPLEFT"}}, {"page_no": 3}]},
        {"self_ref": "#/texts/1", "label": "text", "text": " inner  one "}, {"self_ref": "#/texts/2", "label": "caption", "text": "Cap"}, {"self_ref": "#/texts/3", "label": "list_item", "marker": "*", "text": "point"},
        {"self_ref": "#/texts/10", "label": "page_footer", "text": "foot"}, {"self_ref": "#/texts/4", "label": None, "text": None},
    ],
    "tables": [{"self_ref": "#/tables/0", "label": "table", "captions": [{"$ref": "#/texts/2"}, {"$ref": "#/texts/99"}], "data": {"grid": [[{"text": "a  b"}, {"text": None}], [{"text": "c"}]]}}, {"self_ref": "#/tables/1", "data": {}}],
    "pictures": [{"self_ref": "#/pictures/0", "label": "picture"}, {"self_ref": "#/pictures/1", "label": "picture"}],
}


def test_flatten(spark):
    layouts = spark.createDataFrame([(1, "a.json", json.dumps(LAYOUT)), (2, "b.json", None), (3, "c.json", "{}")], "doc_id long, file string, layout string")
    rows = sorted(flatten.flatten_layouts(layouts).collect(), key=lambda r: r.order)
    assert [r.source_ref for r in rows] == ["#/texts/0", "#/texts/1", "#/texts/2", "#/tables/0", "#/texts/3", "#/pictures/0", "#/tables/1", "#/texts/10", "#/texts/4"]
    first, table = rows[0], rows[3]
    assert (first.type, first.text, first.marker, first.element_id, first.bbox) == ("list_item", "1. First", "1.", "p0002_e00001", [1.0, 2.0, 3.0, 4.0])
    assert (rows[1].text, rows[4].text, rows[8].type, rows[5].text) == ("inner one", "* point", "text", "")
    assert (table.text, table.captions, table.rows, table.row_count, table.col_count) == ("Cap", ["Cap"], [["a b", ""], ["c"]], 2, 2)
    assert (rows[6].row_count, rows[6].col_count) == (0, 0)


DOCS, OUTLINE = "doc_id long, title string, page_count int", "doc_id long, ord int, outline_level int, title string, page int"


def test_outline_tree(spark):
    docs = spark.createDataFrame([(1, "Book", 50), (2, "Bare", 3)], DOCS)
    entries = [(1, 0, 1, "Preface", 3), (1, 1, 1, "PART IV Things", 5), (1, 2, 2, "1. One", 5), (1, 3, 2, "1. One", 9), (1, 4, 1, "Notes", -1), (1, 5, 1, "Appendices", 40), (1, 6, 2, "Appendix II: Two", 99)]
    found = sections.outline_sections(spark.createDataFrame(entries, OUTLINE), docs)
    rows = {r.order: r for r in found.filter("doc_id = 1").collect()}
    assert [rows[i].section_id for i in range(9)] == ["document", "front_matter_pre_outline", "front_matter_001_preface", "part_04_part_iv_things", "ch_001_one", "ch_001_one", "section_001_notes", "appendices", "app_02_two"]
    assert [(rows[i].level, rows[i].start_page, rows[i].end_page) for i in range(9)] == [(0, 1, 50), (1, 1, 2), (1, 3, 4), (1, 5, 39), (2, 5, 8), (2, 9, 9), (2, 1, 39), (1, 40, 50), (2, 50, 50)]
    assert [rows[i].parent_id for i in (2, 4, 6, 8)] == ["document", "part_04_part_iv_things", "part_04_part_iv_things", "appendices"]
    assert rows[3].confidence == 0.98 and rows[6].confidence == 0.9
    assert found.filter("doc_id = 2").count() == 1


def test_heading_tree_and_fallback(spark):
    docs = spark.createDataFrame([(1, "Book", 9), (2, "Other", 9)], DOCS)
    heads = spark.createDataFrame([(1, 0, 3, "A", 1), (1, 1, 1, "B", 2), (1, 2, 4, "C", 2), (1, 3, 2, "D", 4), (1, 4, 4, "E", 0), (1, 5, None, " ", 6), (1, 6, None, "F", 7), (2, 0, 1, "unused", 1)], "doc_id long, ord int, level int, title string, page int")
    outline = spark.createDataFrame([(2, 0, 1, "Start", 1)], OUTLINE)
    rows = {(r.doc_id, r.title): r for r in sections.sections_of(outline, heads, docs).collect()}
    assert {t: rows[1, t].parent_title for t in "ABCDEF"} == {"A": "Book", "B": "Book", "C": "B", "D": "B", "E": "D", "F": "Book"}
    assert rows[1, "B"].end_page == 6 and rows[1, "C"].end_page == 3 and rows[1, "E"].start_page == 1
    assert (2, "unused") not in rows and rows[2, "Start"].source == "pdf_outline"


def test_sections_of_any_depth(spark):
    docs = spark.createDataFrame([(1, "Book", 90)], "doc_id long, title string, page_count int")
    deep = [(1, i, i, f"t{i}", i) for i in range(1, 41)] + [(1, 41, 7, "back", 50), (1, 42, 99, "far", 60)]
    found = {r.title: r for r in sections.heading_sections(spark.createDataFrame(deep, "doc_id long, ord int, level int, title string, page int"), docs).collect()}
    assert all(found[f"t{i}"].parent_title == (f"t{i - 1}" if i > 1 else "Book") and found[f"t{i}"].parent_id == found[f"t{i - 1}" if i > 1 else "Book"].section_id for i in range(1, 41))
    assert (found["back"].parent_title, found["far"].parent_title) == ("t6", "back")
    assert (found["t6"].end_page, found["t7"].end_page, found["t39"].end_page, found["far"].end_page) == (90, 49, 49, 90)
    crumbs = {r.section_id: r.hierarchy for r in sections.breadcrumbs(sections.heading_sections(spark.createDataFrame(deep, "doc_id long, ord int, level int, title string, page int"), docs)).collect()}
    assert crumbs[found["t40"].section_id] == " > ".join(["Book", *(f"t{i}" for i in range(1, 41))])


def test_paths_with_cycles():
    assert sections._paths(["a", "b", "c", "d", "e"], ["A", "B", "C", "", "E"], ["b", "a", "b", "c", "gone"]) == ["B > A", "A > B", "A > B > C", "A > B > C", "E"]


def test_attach_and_breadcrumbs(spark):
    tree = "doc_id long, section_id string, title string, level int, parent_id string, parent_title string, start_page int, end_page int, source string, `order` int"
    rows = [(1, "document", "Book", 0, None, None, 1, 9, "synthetic_root", 0), (1, "a", "A", 1, "document", "Book", 2, 5, "x", 1), (1, "b", "B", 2, "a", "A", 3, 5, "x", 2), (1, "c", " ", 2, "b", "B", 3, 3, "x", 3), (1, "loop", "L", 1, "loop", "L", 8, 7, "x", 4)]
    found = spark.createDataFrame(rows, tree)
    elements = spark.createDataFrame([(1, 1, None), (1, 2, 0), (1, 3, 3), (1, 4, 4), (1, 5, 99)], "doc_id long, seq int, page_num int")
    assert [r.section_id for r in sections.attach_sections(elements, found).orderBy("seq").collect()] == ["document", "document", "c", "b", "document"]
    assert {r.section_id: r.hierarchy for r in sections.breadcrumbs(found).collect()} == {"document": "Book", "a": "Book > A", "b": "Book > A > B", "c": "Book > A > B", "loop": "L"}


def test_gates(spark):
    schema = "doc_id long, seq int, element_id string, page_num int, section_id string, source_parser string, type string, text string, rows array<array<string>>"
    rows = [
        (1, 1, "a", 2, "s", "p", "paragraph", "longMainExamination http://longMainExamination beintroducedhere", None), (1, 2, "b", 1, "s", "p", "text", "this text is in the table", None),
        (1, 3, "t", 1, "s", "p", "table", "Cap", [["so", "this text is"], ["in the table too"]]), (1, 4, "u", 1, "s", "p", "table", "", [["this text is in the table"]]), (1, 5, None, 0, "", None, "text", None, None),
    ]
    elements = spark.createDataFrame(rows, schema)
    tree = spark.createDataFrame([(1, "s", "", 5, 2), (1, "", "x", 1, 1), (1, "n", "x", None, 1)], "doc_id long, section_id string, title string, start_page int, end_page int")
    issues = gate.all_issues(elements, tree)
    by = {}
    for r in issues.collect():
        by.setdefault(r.check, []).append(r.message)
    assert by["text_reconstruction_issues"] == ["Element a contains potential word-join artifact: 'longMainExamination'"]
    assert by["table_duplication_issues"] == ["Potential table content duplicated in text element b near table t"]
    assert len(by["reading_order_issues"]) == 3 and len(by["section_tree_issues"]) == 4 and by["provenance_issues"] == ["Element found without an element_id."]
    rolled = gate.roll_up(issues, spark.createDataFrame([(1,), (2,)], "doc_id long"))
    assert {r.doc_id: r.passed for r in gate.verdict(rolled).collect()} == {1: False, 2: True}
    assert rolled.count() == 10


def test_pack_fixture(spark):
    units = spark.createDataFrame([(1, i, n) for i, n in enumerate((400, 500, 300, 1200, 10, 0, 995))], "doc_id long, seq int, tokens int")
    assert [r.chunk_no for r in chunk.pack(units, 1000).orderBy("seq").collect()] == [1, 1, 2, 3, 4, 4, 5]


def folded(tokens, budget):
    out, held, number = [], 0, 1
    for n in tokens:
        if held > 0 and held + n > budget:
            held, number = 0, number + 1
        held += n
        out.append(number)
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=30), min_size=1, max_size=5))
def test_pack_property(spark, docs):
    rows = [(d, i, n) for d, tokens in enumerate(docs) for i, n in enumerate(tokens)]
    found = chunk.pack(spark.createDataFrame(rows, "doc_id long, seq int, tokens int"), 50).orderBy("doc_id", "seq").collect()
    assert [r.chunk_no for r in found] == [x for tokens in docs for x in folded(tokens, 50)]


def test_chunks(spark):
    rows = [(1, 1, "paragraph", "one two three", 1, "s1", None), (1, 2, "picture", "", 1, "s1", None), (1, 3, "table", "Cap", 2, None, [["a|b", " c\nd "], [None, ""]]), (1, 4, "paragraph", None, 3, "s2", None), (1, 5, "text", "last words here now", 0, None, None)]
    elements = spark.createDataFrame(rows, "doc_id long, seq int, type string, text string, page_num int, section_id string, rows array<array<string>>")
    found = chunk.chunks(elements, 4, 2).orderBy("chunk_no").collect()
    assert [(c.chunk_id, c.page_range, c.section_id, c.prev_chunk_tail) for c in found] == [("chunk_0001", [1], "s1", ""), ("chunk_0002", [2], "s1", "two three"), ("chunk_0003", [], "s1", "d |")]
    assert found[1].text == "Table Caption: Cap\na\\|b | c d\n | "


def test_stream_reply_and_markdown(spark):
    lines = [(1, 1, 'data: {"choices":[{"delta":{"content":"He"}}]}'), (1, 2, ": comment"), (1, 3, "data: {bad"), (1, 4, 'data: {"choices":[],"usage":{"completion_tokens":3}}'), (1, 5, 'data: {"choices":[{"delta":{"content":"y"}}]}'), (1, 6, "data: [DONE]"), (1, 7, 'data: {"choices":[{"delta":{"content":"late"}}]}'), (2, 1, "data: [DONE]"), (3, 1, "data: {}")]
    rows = {r.request: r for r in vision.stream_reply(spark.createDataFrame(lines, "request int, seq int, line string")).collect()}
    assert rows[1].content == "Hey" and rows[1].usage.completion_tokens == 3
    assert rows[3].error == "Streaming provider returned no assistant text."
    parts = spark.createDataFrame([(1, 10, "b"), (1, 2, "a")], "doc_id long, start_page int, markdown string")
    assert files.joined_markdown(parts).first().markdown == "a\n\nb"


def test_sources_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, None)], "doc_id long, text string")
    files.write_jsonl(df, str(tmp_path / "x"))
    assert sorted((r.doc_id, r.text) for r in files.read_jsonl(spark, str(tmp_path / "x"), "doc_id long, text string").collect()) == [(1, "é"), (2, None)]
    (tmp_path / "book.docling.json").write_text(json.dumps(LAYOUT))
    layouts = files.read_layouts(spark, str(tmp_path / "*.docling.json"))
    assert flatten.flatten_layouts(layouts).count() == 9
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    found = files.read_pdfs(spark, str(tmp_path / "*.pdf"), lambda path, content: iter([{"name": path[-5:], "n": len(content)}]), "name string, n int").first()
    assert (found.name, found.n) == ("a.pdf", 4)
    extra = files.with_optional(df, spark.createDataFrame([(3, 0.5)], "doc_id long, confidence double"))
    assert extra.count() == 3 and "confidence" in extra.columns


def test_environment():
    env = read_env("# c\nexport VLM_LOCAL_MODEL='m'\nVLM_REQUEST_TIMEOUT=5\nA=1", {"A": "2"})
    options = options_from(env | {"OPENAI_BASE_URL": "http://x"})
    assert (env["A"], options.local_model, options.local_base_url, options.request_timeout) == ("2", "m", "http://x", 120)
    assert artifact_stem("b", 12345, 12346) == "b.p12345-p12346"


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(1, 1, "e", 0, "s", "p")], "doc_id long, seq int, element_id string, page_num int, section_id string, source_parser string").write.json(str(src))
    stream = ingest.stream_provenance(ingest.stream_elements(spark, str(src), "doc_id long, seq int, element_id string, page_num int, section_id string, source_parser string"))
    q = stream.writeStream.format("memory").queryName("issues").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select message from issues").first().message == "Element e is missing page_num."


def test_gateway():
    import io
    import urllib.error

    from pagewright.sources.gateway import Gateway, from_environment

    class Reply(io.BytesIO):
        pass

    asked = []

    def opener(request, timeout):
        asked.append((request.full_url, json.loads(request.data) if request.data else None))
        if request.full_url.endswith("/models"):
            return Reply(b'{"data":[{"id":"b"},{"id":""},{"id":"a"}]}')
        if json.loads(request.data).get("stream"):
            return Reply(b'data: {"choices":[{"delta":{"content":"He"}}]}\n: x\ndata: {bad\ndata: {"choices":[{"delta":{"content":"y"}}],"usage":{"completion_tokens":2}}\ndata: [DONE]\ndata: {"choices":[{"delta":{"content":"!"}}]}\n')
        return Reply(GOOD.encode())

    gate = Gateway("http://h:1/v1/v1/", "k", opener=opener)
    assert gate.models() == ["a", "b"] and gate.require("a") and asked[0][0] == "http://h:1/v1/models"
    with pytest.raises(vision.ProviderError, match="Available models: a, b"):
        gate.require("c")
    assert gate.chat({"messages": [1]})["summary"] == "Page." and asked[-1][1] == {"messages": [1]}
    streamed = Gateway("http://h:1", "k", stream=True, opener=opener).chat({})
    assert streamed["choices"][0]["message"]["content"] == "Hey" and streamed["usage"] == {"completion_tokens": 2}

    def refused(request, timeout):
        raise urllib.error.HTTPError(request.full_url, 401, "secret", {}, io.BytesIO(b"secret body"))

    with pytest.raises(vision.ProviderError) as e:
        Gateway("http://h", "k", opener=refused).chat({})
    assert "authentication failed" in str(e.value) and "secret" not in str(e.value)
    with pytest.raises(vision.ProviderError, match="requires"):
        from_environment({})
    assert from_environment({"OPENAI_BASE_URL": "http://x", "VLM_LOCAL_API_KEY": "k"}).url == "http://x/v1"


def test_manifest_and_reports(spark):
    pages = spark.createDataFrame([(1, 1, 400, 0, 0.0, 0), (1, 2, 0, 0, 0.0, 250)], SIGNALS)
    routed = route.route_vlm(pages)
    row = verify.manifest(route.plan_summary(routed), verify.plan_only_decisions(routed)).first()
    assert [d.decision for d in row.decisions] == ["not_run_plan_only"] * 2 and row.vlm_pages == [2]
    report = verify.run_report(verify.plan_only_decisions(routed), spark.createDataFrame([(1, 2)], "doc_id long, page_count int")).first()
    assert not report.passed
    done = spark.createDataFrame([(1, True, 1.005, 3, 1), (1, False, 2.0, 4, 0)], "doc_id long, passed boolean, seconds double, text_element_count int, table_count int")
    assert verify.conversion_report(done, plan_only=True).first().warnings == ["One or more hybrid range conversions did not pass Phase 1A checks.", "Plan-only mode did not run Docling conversions."]
    assert sections.outline_gaps(spark.createDataFrame([(1, "A b"), (1, "C")], "doc_id long, title string"), spark.createDataFrame([(1, "a  B")], "doc_id long, title string")).first().slug == "c"


def test_late_events_are_left_out(spark, tmp_path):
    from datetime import datetime, timedelta

    schema, start = "ts timestamp, event_type string, value double", datetime(2024, 1, 1)
    rows = [[(start + timedelta(minutes=m), "a", 1.0) for m in (0, 10, 70)], [(start + timedelta(hours=9), "a", 1.0)], [(start + timedelta(minutes=5), "a", 100.0), (start + timedelta(hours=20), "a", 1.0)]]
    src = tmp_path / "events"
    counts = ingest.stream_event_counts(spark.readStream.schema(schema).parquet(str(src)) if src.mkdir() is None else None)
    q = counts.writeStream.format("memory").queryName("counts").outputMode("append").start()
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(src))
        q.processAllAvailable()
    q.stop()
    found = {(r.s.hour, r.n, r.total) for r in spark.sql("select window.start as s, n, total from counts").collect()}
    assert {(0, 2, 2.0), (1, 1, 1.0)} <= found and all(total < 100 for _, _, total in found)
