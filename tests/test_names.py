from hitloom.functions.text import alias_name, sanitize_name, unique_names
from hitloom.config import Settings
from hitloom.sources.feed import hit_schema


def test_sanitize_name():
    cases = {
        " Hit Time ": "hit_time", '"quoted"': "quoted", "'x'": "x", "a--b__c": "a_b_c", "_lead_": "lead",
        "9lives": "f_9lives", "": "col", "%%": "col", "'": "col", "ÄB": "b", "'\"two": "two",
    }
    assert {raw: sanitize_name(raw) for raw in cases} == cases


def test_unique_names_never_repeat():
    assert unique_names(["a", "b", "a", "a"]) == ["a", "b", "a_2", "a_3"]
    assert unique_names(["a", "a_2", "a", "a_2"]) == ["a", "a_2", "a_3", "a_2_2"]


def test_hit_schema_reads_the_first_line():
    assert hit_schema("Hit ID,Hit ID,2x\nother,line").names == ["hit_id", "hit_id_2", "f_2x"]


def test_alias_name_keeps_every_position():
    assert alias_name("New vs. Repeat", "prop_") == "prop_new_vs__repeat"


def test_settings_from_nested_document():
    doc = {
        "validation": {"expectedRows": 5, "expectedErrors": 7},
        "pipeline_config": {
            "visitor_id_precedence": ["mcvisid", "fallback"],
            "page_view_detection": {"use_post_page_event": False, "use_url_change": True},
            "measurement_event_codes": [1, 2],
            "ignore_hits": [3],
            "data_quality": {"null_timestamp_warn_pct": 0.2, "bad_rows_warn_pct": 1},
            "name_source": "literal",
        },
    }
    s = Settings.from_dict(doc)
    assert s.visitor_precedence == ("mcvisid", "fallback")
    assert (s.use_post_page_event, s.use_url_change) == (False, True)
    assert (s.measurement_codes, s.ignore_codes) == ((1, 2), (3,))
    assert (s.expected_rows, s.max_bad_records, s.null_timestamp_warn_pct) == (5, 7, 0.2)
    assert s.name_source == "literal"
    assert Settings.from_dict({}) == Settings()
