"""Sources and sections: from nested settings to dimension tables."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.dates import DateFormatError, engine_pattern
from paperloom.functions.html import SELECTOR_TYPE, SelectorError, compile_selector, selector_value

# How a source names its listing parameters unless it says otherwise.
LISTING_DEFAULTS = {"date_format": "%d/%m/%Y", "date_from": "from", "date_to": "to", "page": "pageNumber"}

REQUIRED_SELECTORS = ("listing_row", "identifier", "title", "description", "published_date",
                      "detail_link", "next_page", "content_container")
OPTIONAL_SELECTORS = ("empty_result", "doc_link")
SELECTORS = REQUIRED_SELECTORS + OPTIONAL_SELECTORS

_SECTION_KEYS = {"url", "selectors", "partition_days"}
_SOURCE_REQUIRED = {
    "base_url": str, "user_agent": str, "download_delay": float, "concurrent_requests": int,
    "http_timeout": int, "robots_obey": bool, "autothrottle_enabled": bool,
    "autothrottle_start_delay": float, "autothrottle_max_delay": float, "retry_enabled": bool,
    "retry_times": int, "retry_http_codes": list, "proxy_enabled": bool, "proxy_list_path": str,
}
_SOURCE_KEYS = set(_SOURCE_REQUIRED) | {"listing_params", "date_range", "sections"}

DEFAULT_PARTITION_DAYS = 30


class ConfigError(ValueError):
    """Settings that must not reach a run."""


def date_pattern(date_format: str, parsing: bool) -> str:
    """A format of the settings as an engine pattern; listings are read and written with it."""
    try:
        engine_pattern(date_format, True)
        return engine_pattern(date_format, parsing)
    except DateFormatError as error:
        raise ConfigError(str(error)) from None


@dataclass
class Settings:
    """Checked settings, one dict per source and per section."""

    sources: dict[str, dict] = field(default_factory=dict)
    sections: dict[str, dict] = field(default_factory=dict)


def _refuse_unknown(given: dict, known: set[str], where: str) -> None:
    unknown = sorted(set(given) - known)
    if unknown:
        raise ConfigError(f"{where}: unknown keys {unknown}")


def _check_selectors(selectors: dict, where: str) -> dict:
    _refuse_unknown(selectors, set(SELECTORS), where)
    missing = [name for name in REQUIRED_SELECTORS if not selectors.get(name)]
    if missing:
        raise ConfigError(f"{where}: missing selectors {missing}")
    out = {name: selectors.get(name) for name in SELECTORS}
    if isinstance(out["identifier"], str):
        out["identifier"] = [out["identifier"]]
    for name in SELECTORS:
        for one in out["identifier"] if name == "identifier" else [out[name]]:
            if one is not None:
                try:
                    compile_selector(one)
                except SelectorError as problem:
                    raise ConfigError(f"{where}: {name}: {problem}") from problem
    return out


def _check_source(source_id: str, given: dict) -> dict:
    where = f"source {source_id!r}"
    _refuse_unknown(given, _SOURCE_KEYS, where)
    missing = sorted(set(_SOURCE_REQUIRED) - set(given))
    if missing:
        raise ConfigError(f"{where}: missing keys {missing}")
    for key, kind in _SOURCE_REQUIRED.items():
        value = given[key]
        accepted = (int, float) if kind is float else kind
        if not isinstance(value, accepted) or (kind in (int, float) and isinstance(value, bool)):
            raise ConfigError(f"{where}: {key} must be {kind.__name__}")
    listing = given.get("listing_params", dict(LISTING_DEFAULTS))
    missing = sorted(set(LISTING_DEFAULTS) - set(listing))
    if missing:
        raise ConfigError(f"{where}: listing_params lack {missing}")
    bounds = given.get("date_range", {})
    _refuse_unknown(bounds, {"start_inclusive", "end_inclusive"}, where)
    return {
        **{key: given[key] for key in _SOURCE_REQUIRED},
        "source_id": source_id,
        "date_parse": date_pattern(listing["date_format"], parsing=True),
        "date_show": date_pattern(listing["date_format"], parsing=False),
        "date_from": listing["date_from"], "date_to": listing["date_to"], "page_param": listing["page"],
        "start_inclusive": bounds.get("start_inclusive", True),
        "end_inclusive": bounds.get("end_inclusive", True),
    }


def read_settings(nested: dict) -> Settings:
    """Check settings of the shape ``{"sources": {id: {…, "sections": {id: …}}}}``.

    Any problem is raised here, before a run starts.
    """
    settings = Settings()
    for source_id, source in (nested.get("sources") or {}).items():
        settings.sources[source_id] = _check_source(source_id, source)
        for section_id, section in (source.get("sections") or {}).items():
            where = f"section {section_id!r}"
            _refuse_unknown(section, _SECTION_KEYS, where)
            if not section.get("url"):
                raise ConfigError(f"{where}: url is missing")
            days = section.get("partition_days", DEFAULT_PARTITION_DAYS)
            if not isinstance(days, int) or isinstance(days, bool) or days < 1:
                raise ConfigError(f"{where}: partition_days must be a whole number >= 1")
            settings.sections[section_id] = {
                "section_id": section_id, "source_id": source_id, "url": section["url"],
                "partition_days": days,
                **_check_selectors(section.get("selectors") or {}, where),
            }
    return settings


def read_settings_file(path: str) -> Settings:
    """Settings from a YAML file, where a YAML library is installed."""
    import yaml

    with open(path) as handle:
        return read_settings(yaml.safe_load(handle) or {})


_SOURCE_SCHEMA = T.StructType([
    T.StructField(name, kind) for name, kind in [
        ("source_id", T.StringType()), ("base_url", T.StringType()), ("date_parse", T.StringType()),
        ("date_show", T.StringType()), ("date_from", T.StringType()), ("date_to", T.StringType()),
        ("page_param", T.StringType()), ("start_inclusive", T.BooleanType()),
        ("end_inclusive", T.BooleanType()), ("retry_http_codes", T.ArrayType(T.IntegerType())),
    ]
])

SECTION_DDL = (
    "section_id string, source_id string, url string, partition_days int, "
    "identifier array<string>, "
    + ", ".join(f"{name} string" for name in SELECTORS if name != "identifier")
    + f", identifier_sel array<{SELECTOR_TYPE}>, "
    + ", ".join(f"{name}_sel {SELECTOR_TYPE}" for name in SELECTORS if name != "identifier")
)


def section_row(section: dict) -> dict:
    """A section with its selectors compiled, as a row of the section table."""
    row = dict(section)
    for name in SELECTORS:
        if name == "identifier":
            row["identifier_sel"] = [selector_value(one) for one in section["identifier"]]
        else:
            row[f"{name}_sel"] = selector_value(section[name])
    return row


def shared_selectors(settings: Settings) -> dict | None:
    """The selectors of a listing, if all sections have the same; else None."""
    sets = [{name: section[name] for name in SELECTORS if name not in ("doc_link", "content_container")}
            for section in settings.sections.values()]
    return sets[0] if sets and all(one == sets[0] for one in sets) else None


def source_table(spark: SparkSession, settings: Settings) -> DataFrame:
    rows = [{name: source[name] for name in _SOURCE_SCHEMA.names} for source in settings.sources.values()]
    return spark.createDataFrame(rows, _SOURCE_SCHEMA)


def section_table(spark: SparkSession, settings: Settings) -> DataFrame:
    return spark.createDataFrame([section_row(s) for s in settings.sections.values()], SECTION_DDL)


def dimension(spark: SparkSession, settings: Settings) -> DataFrame:
    """Sections with the fields of their source: what page jobs join to."""
    return section_table(spark, settings).join(source_table(spark, settings), "source_id")


def sections_of_source(settings: Settings, source_id: str) -> list[dict]:
    """Sections of a source by id; an unknown source is an error."""
    if source_id not in settings.sources:
        raise ConfigError(f"unknown source {source_id!r}")
    return [settings.sections[key] for key in sorted(settings.sections)
            if settings.sections[key]["source_id"] == source_id]


def section_problems(sections: DataFrame) -> DataFrame:
    """The settings contract as rules over a section table, one row per breach."""
    def rule(name: str, broken: Column) -> Column:
        return F.when(F.coalesce(broken, F.lit(True)), F.lit(name))

    simple = r"(?:[a-zA-Z][a-zA-Z0-9]*(?:\.[A-Za-z_][\w-]*)*|(?:\.[A-Za-z_][\w-]*)+)"
    grammar = rf"^\s*{simple}(?:\s+{simple})?\s*$"
    rules = [rule("partition_days", F.col("partition_days") < 1),
             rule("url", F.col("url") == ""),
             rule("identifier", (F.size("identifier") < 1)
                  | F.exists("identifier", lambda one: ~F.rlike(one, F.lit(grammar))))]
    for name in REQUIRED_SELECTORS:
        if name != "identifier":
            rules.append(rule(name, ~F.rlike(F.col(name), F.lit(grammar))))
    for name in OPTIONAL_SELECTORS:
        rules.append(F.when(F.col(name).isNotNull() & ~F.rlike(F.col(name), F.lit(grammar)), F.lit(name)))
    return sections.select("section_id", F.explode(F.array_compact(F.array(*rules))).alias("broken_rule"))
