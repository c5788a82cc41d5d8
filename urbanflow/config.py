"""Job configuration, read from the environment (no literal endpoints or secrets)."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class LakePaths:
    """Zone prefixes of the lake: raw landing, curated, gold."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def curated(self) -> str:
        return f"{self.root}/curated"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"


@dataclass(frozen=True)
class FeedConfig:
    """One config key per feed (topic name, landing path, checkpoint)."""

    bootstrap_servers: str = "localhost:9092"
    # Topic names of the feeds (weather, multi-topic set, PM sensor).
    weather_topic: str = "weather"
    topics: tuple[str, ...] = ("weather", "traffic", "air_quality")
    pm_topic: str = "pm10-data"
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    trigger_interval: str = "1 minute"
    producer_options: dict[str, str] = field(default_factory=lambda: {
        # delivery settings of the feed producer (acks, retries, ordering, timeout) as sink options
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.max.in.flight.requests.per.connection": "1",
        "kafka.request.timeout.ms": "30000",
    })


def feed_config_from_env(env: dict[str, str] | None = None) -> FeedConfig:
    env = dict(os.environ if env is None else env)
    topics = tuple(t.strip() for t in env.get("URBANFLOW_TOPICS", "weather,traffic,air_quality").split(",") if t.strip())
    mopt = env.get("URBANFLOW_MAX_OFFSETS_PER_TRIGGER")
    mpart = env.get("URBANFLOW_MIN_PARTITIONS")
    return FeedConfig(
        bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"),
        weather_topic=env.get("URBANFLOW_WEATHER_TOPIC", "weather"),
        topics=topics,
        pm_topic=env.get("URBANFLOW_PM_TOPIC", "pm10-data"),
        starting_offsets=env.get("URBANFLOW_STARTING_OFFSETS", "latest"),
        max_offsets_per_trigger=int(mopt) if mopt else None,
        min_partitions=int(mpart) if mpart else None,
        trigger_interval=env.get("URBANFLOW_TRIGGER", "1 minute"),
    )


def lake_paths_from_env(env: dict[str, str] | None = None, default_root: str | None = None) -> LakePaths:
    env = dict(os.environ if env is None else env)
    root = env.get("URBANFLOW_LAKE_ROOT", default_root)
    if not root:
        raise ValueError("URBANFLOW_LAKE_ROOT is not set")
    return LakePaths(root.rstrip("/"))
