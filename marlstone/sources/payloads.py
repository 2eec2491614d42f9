"""The landing zone: payload files with their metadata, archived and never overwritten.

Fetching is outside the engine; any fetcher that leaves rows of schemas.PAYLOAD
can feed it. Here are the rules such a fetcher needs (robots, retries, pace),
and the reading and archiving of what it brought.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.schemas import PAYLOAD

#: Attempts after the first, base of the back-off, and the answers that are worth another try.
RETRIES, BACKOFF_SECONDS = 2, 1.0
RETRYABLE = {408, 425, 429, 500, 502, 503, 504, *range(520, 528)}
EXTENSIONS = {"text/calendar": "ics", "application/json": "json", "text/html": "html", "application/rss+xml": "xml", "application/atom+xml": "xml", "application/xml": "xml", "text/xml": "xml"}


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Payload rows of a Parquet landing zone."""
    return spark.read.schema(PAYLOAD).parquet(path)


def read_files(spark: SparkSession, path: str, space_id: str, source_label: str, content_type: str, url: str = "") -> DataFrame:
    """Files as answered payloads of one source."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.lit(space_id).alias("space_id"), F.lit(source_label).alias("source_label"), F.lit(url).alias("url"), F.lit(200).alias("status"), F.lit(content_type).alias("content_type"), F.create_map().cast("map<string,string>").alias("headers"), F.col("content").alias("body"), F.lit("fetched").alias("outcome"), F.col("modificationTime").alias("fetched_at"))


def archive(payloads: DataFrame, path: str) -> None:
    """Append bodies that the archive doesn't hold yet, by digest, under source and day."""
    spark = payloads.sparkSession
    hashed = payloads.withColumns({"sha256": F.sha2("body", 256), "day": F.to_date("fetched_at"), "extension": extension(F.col("content_type"))})
    hashed = hashed.dropDuplicates(["space_id", "source_label", "sha256"])
    try:
        old = spark.read.parquet(path).select("space_id", "source_label", "sha256")
        hashed = hashed.join(old, ["space_id", "source_label", "sha256"], "left_anti")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    hashed.write.mode("append").partitionBy("day").parquet(path)


def extension(content_type: Column) -> Column:
    kind = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    known = F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, kind), F.when(kind.endswith("+json"), "json").when(kind.endswith("+xml"), "xml"), F.lit("bin"))


def delays(statuses: Iterable[int]) -> list[float]:
    """Waits between attempts for a run of answers: doubled each time, ending at an answer that is final or when tries run out."""
    waits: list[float] = []
    for n, status in enumerate(statuses):
        if status not in RETRYABLE or n >= RETRIES:
            break
        waits.append(BACKOFF_SECONDS * 2**n)
    return waits


@dataclass
class Pace:
    """Least time between requests to one host."""

    clock: Callable[[], float]
    sleep: Callable[[float], None]
    last: dict[str, float] = field(default_factory=dict)

    def wait(self, host: str, gap: float) -> float:
        pause = max(0.0, self.last.get(host, float("-inf")) + gap - self.clock())
        if pause:
            self.sleep(pause)
        self.last[host] = self.clock()
        return pause


@dataclass
class Robots:
    """A host's rules: both our agent and * must allow a path; 4xx allows all, other failures nothing."""

    groups: dict[str, list[tuple[bool, str]]] = field(default_factory=dict)
    crawl_delays: dict[str, float] = field(default_factory=dict)
    reachable: bool = True

    @staticmethod
    def of(status: int | None, text: str = "") -> Robots:
        if status is None or (status != 200 and not 400 <= status < 500):
            return Robots(reachable=False)
        robots = Robots()
        if status != 200:
            return robots
        agents: list[str] = []
        in_rules = False
        for line in text.splitlines():
            name, _, value = line.split("#", 1)[0].partition(":")
            name, value = name.strip().lower(), value.strip()
            if name == "user-agent":
                agents = [value.lower()] if in_rules else [*agents, value.lower()]
                in_rules = False
            elif name in ("allow", "disallow", "crawl-delay"):
                in_rules = True
                for agent in agents:
                    if name == "crawl-delay":
                        try:
                            robots.crawl_delays[agent] = float(value)
                        except ValueError:
                            continue
                    elif value:
                        robots.groups.setdefault(agent, []).append((name == "allow", value))
        return robots

    def _allowed(self, agent: str, path: str) -> bool:
        rules = [(len(p), ok) for ok, p in self.groups.get(agent, []) if path.startswith(p.rstrip("*"))]
        return max(rules, default=(0, True))[1]

    def allows(self, agent: str, path: str) -> bool:
        own = next((a for a in self.groups if a != "*" and a in agent.lower()), "*")
        return self.reachable and self._allowed(own, path) and self._allowed("*", path)

    def delay(self, agent: str, least: float) -> float:
        return max([least, *(d for a, d in self.crawl_delays.items() if a == "*" or a in agent.lower())])
