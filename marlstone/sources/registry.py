"""The declarative registry: a YAML tree of spaces and sources, validated, as two DataFrames."""

from __future__ import annotations

import re
from collections.abc import Mapping
from pathlib import Path
from typing import Any, Literal
from urllib.parse import parse_qsl, quote, unquote, urlencode, urlsplit, urlunsplit

import yaml
from pydantic import BaseModel, ConfigDict, Field, model_validator
from pyspark.sql import DataFrame, SparkSession

from marlstone.schemas import SOURCES, SPACES

#: Fixed format: where a public calendar's iCalendar file lies.
CALENDAR_URL = "https://calendar.google.com/calendar/ical/{}/public/basic.ics"
NEEDS = {"gcal_ics": "calendar_id", "embedded_json": "script_id", "json": "shape"}


#: libyaml's parser where it is there: the same documents, some ten times as fast.
LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)


class RegistryError(ValueError):
    pass


class _Strict(BaseModel):
    model_config = ConfigDict(extra="forbid")


class FilterSpec(_Strict):
    title_contains: list[str] = []
    title_excludes: list[str] = []
    location_contains: list[str] = []
    location_excludes: list[str] = []
    categories_exclude: list[str] = []
    location_allow_when_missing: bool = True


class HealthSpec(_Strict):
    allow_zero: bool = False
    ignore_count_drop: bool = False
    require_nonzero_once: bool = False
    max_stale_days: int | None = None


class SourceSpec(_Strict):
    model_config = ConfigDict(extra="allow")
    adapter: str
    label: str | None = None
    url: str | None = None
    calendar_id: str | None = None
    enabled: bool = True
    todo: bool | str = False
    trust: int = 0
    params: dict[str, Any] = {}
    script_id: str | None = None
    shape: str | None = None
    rss_mode: Literal["events", "change_detection", "seed_list"] | None = None
    pubdate_means: str | None = None
    filters: FilterSpec = FilterSpec()
    health: HealthSpec = HealthSpec()

    @model_validator(mode="after")
    def _target(self):
        need = NEEDS.get(self.adapter, "url")
        if self.enabled and not self.todo and not getattr(self, need):
            raise ValueError(f"{self.adapter} needs {need}")
        return self

    @property
    def key(self) -> str:
        return self.label or self.adapter


class SpaceSpec(_Strict):
    model_config = ConfigDict(extra="allow")
    id: str
    name: str
    url: str | None = None
    timezone: str | None = None
    address_override: str | None = None
    health: HealthSpec = HealthSpec()
    sources: list[SourceSpec] = []

    @model_validator(mode="after")
    def _unique(self):
        keys = [s.key for s in self.sources]
        if len(set(keys)) < len(keys):
            raise ValueError(f"{self.id}: source labels repeat")
        return self


class Registry(_Strict):
    model_config = ConfigDict(extra="allow")
    defaults: dict[str, Any] = {}
    spaces: list[SpaceSpec] = Field(default_factory=list)

    @model_validator(mode="after")
    def _unique(self):
        ids = [s.id for s in self.spaces]
        if len(set(ids)) < len(ids):
            raise ValueError("space ids repeat")
        return self

    def frames(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """(spaces, sources) in schemas.SPACES and SOURCES, in registry order: a few rows each."""
        zone = self.defaults.get("timezone", "America/Los_Angeles")
        spaces = [(s.id, s.name, s.url, s.timezone or zone, s.address_override, i, s.health.model_dump()) for i, s in enumerate(self.spaces)]
        rows, n = [], 0
        for space in self.spaces:
            for s in space.sources:
                rows.append((space.id, s.key, s.adapter, source_url(s), s.calendar_id, s.enabled, bool(s.todo), s.trust, {k: str(v) for k, v in s.params.items()}, s.script_id, s.shape, s.rss_mode or ("change_detection" if s.adapter == "rss" else None), s.pubdate_means, s.filters.model_dump(), s.health.model_dump(), n))
                n += 1
        return spark.createDataFrame(spaces, SPACES), spark.createDataFrame(rows, SOURCES)


def expanded(value: Any, values: Mapping[str, str]) -> Any:
    """${NAME} placeholders in every string; an unknown name is an error."""
    if isinstance(value, str):

        def fill(m: re.Match) -> str:
            if m[1] not in values:
                raise RegistryError(f"no value for ${{{m[1]}}}")
            return values[m[1]]

        return re.sub(r"\$\{(\w+)\}", fill, value)
    if isinstance(value, list):
        return [expanded(v, values) for v in value]
    return {k: expanded(v, values) for k, v in value.items()} if isinstance(value, dict) else value


def dotenv(text: str) -> dict[str, str]:
    """NAME=value lines; quotes and export are dropped, comments and other lines ignored."""
    found = {}
    for line in text.splitlines():
        if m := re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line):
            value = m[2]
            quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "'\""
            found[m[1]] = value[1:-1] if quoted else re.sub(r"\s+#.*$", "", value)
    return found


def load(text_or_path: str | Path, env: Mapping[str, str]) -> Registry:
    text = Path(text_or_path).read_text() if isinstance(text_or_path, Path) else text_or_path
    try:
        return Registry.model_validate(expanded(yaml.load(text, Loader=LOADER) or {}, env))
    except ValueError as error:
        raise RegistryError(str(error)) from error


def calendar_url(calendar_id: str) -> str:
    """The address of a public calendar, from its id, encoded or not."""
    return CALENDAR_URL.format(quote(unquote(calendar_id.strip()), safe=""))


def source_url(source: SourceSpec) -> str | None:
    """The request address: the calendar's, or the url with params merged in."""
    if source.adapter == "gcal_ics" and source.calendar_id:
        return calendar_url(source.calendar_id)
    if not source.url or not source.params:
        return source.url
    parts = urlsplit(source.url)
    own = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k not in source.params]
    return urlunsplit(parts._replace(query=urlencode([*own, *((k, str(v)) for k, v in source.params.items())])))


def runnable(sources: DataFrame, space: str | None = None) -> DataFrame:
    """Sources in registry order with run and skip_reason: disabled, unfinished, or of another space."""
    from pyspark.sql import functions as F

    out = sources if space is None else sources.where(F.col("space_id") == space)
    why = F.when(~F.col("enabled"), "disabled").when(F.col("todo"), "todo").when(F.col("adapter") == "llm_html", "not_implemented")
    return out.withColumns({"skip_reason": why, "run": why.isNull()}).orderBy("ordinal")
