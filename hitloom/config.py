"""Settings of the layers, with the defaults of the sample configuration."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace
from pathlib import Path

# The four sources of a visitor identity, in order of trust.
VISITOR_PRECEDENCE = ("post_visid", "mcvisid", "post_cust_visid", "fallback")

# Event codes that carry a measurement instead of an event.
MEASUREMENT_CODES = (200, 209, 236, 240)


@dataclass(frozen=True)
class Settings:
    """What can be tuned from raw to gold."""

    visitor_precedence: tuple[str, ...] = VISITOR_PRECEDENCE
    measurement_codes: tuple[int, ...] = MEASUREMENT_CODES
    ignore_codes: tuple[int, ...] = ()
    use_post_page_event: bool = True
    use_url_change: bool = True
    use_evar_instances: bool = False
    # "literal" names events "Event <code>"; "event_map" looks the name up.
    name_source: str = "event_map"
    # "inline" holds all names of events in memory, "join" joins them; "auto" holds those
    # whose codes occur, or joins them if they are too many.
    event_lookup: str = "auto"
    # Custom event N has code base + N; eVar N above 100 has code offset + N.
    custom_event_base: int = 199
    evar_code_offset: int = 9899
    # An eVar instance with code c belongs to eVar number c - offset.
    evar_number_offset: int = 9999
    keep_raw: bool = False
    drop_malformed: bool = False
    expected_rows: int = 0
    max_bad_records: int = 10000
    padding_tolerance: int = 3
    null_timestamp_warn_pct: float = 0.1
    empty_visitor_id_warn_pct: float = 0.05
    unknown_events_warn_pct: float = 0.1

    @classmethod
    def from_dict(cls, doc: dict) -> "Settings":
        """Read the nested layout users keep in ``config.json``."""
        block = doc.get("pipeline_config", {})
        views = block.get("page_view_detection", {})
        checks = doc.get("validation", {})
        found = {
            "visitor_precedence": block.get("visitor_id_precedence"),
            "measurement_codes": block.get("measurement_event_codes"),
            "ignore_codes": block.get("ignore_hits"),
            "use_post_page_event": views.get("use_post_page_event"),
            "use_url_change": views.get("use_url_change"),
            "expected_rows": checks.get("expectedRows"),
            "max_bad_records": checks.get("expectedErrors"),
            "padding_tolerance": doc.get("paddingTolerance"),
        }
        known = {field.name for field in fields(cls)}
        found.update({k: v for k, v in block.get("data_quality", {}).items() if k in known})
        # Options that exist only here keep their own name in the same block.
        found.update({k: v for k, v in block.items() if k in known})
        clean = {k: tuple(v) if isinstance(v, list) else v for k, v in found.items() if v is not None}
        return replace(cls(), **clean)

    @classmethod
    def from_json(cls, path: str | Path) -> "Settings":
        return cls.from_dict(json.loads(Path(path).read_text()))
