"""What a user sets for a pipeline."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from logforge.operators.batching import BATCH_TARGET, RECORD_OVERHEAD

# Integration names; one has a second name.
OBJECT_SOURCES = ["S3", "S3Csv", "CloudFront", "VpcFlow", "CloudTrail"]
RECORD_SOURCES = ["CloudWatch", "Kinesis", "Sqs", "Sns", "Kafka", "EcrScan"]
COMPRESSED_SOURCES = ["VpcFlow", "CloudTrail"]
INTEGRATION_ALIASES = {"MSK": "Kafka"}


@dataclass(frozen=True)
class LogConfig:
    """Settings of ``ship_logs``. ``application`` / ``subsystem`` left out take the default
    of their source. ``compression`` is what ``decode_objects`` and ``read_paths`` need for its
    objects."""

    integration: str
    application: str | None = None
    subsystem: str | None = None
    newline_pattern: str = r"\n"
    block: str = ""
    stream_filter: str = ""
    sample: int = 1
    delimiter: str = ","
    header: str = ""
    transform: Callable | None = None
    add_metadata: list[str] = field(default_factory=list)
    labels: dict[str, str] = field(default_factory=dict)
    detect_severity: bool = True
    batch_target: int = BATCH_TARGET
    record_overhead: int = RECORD_OVERHEAD

    @property
    def compression(self) -> str:
        """How objects of the integration are compressed: some always are, others if named so."""
        return "gzip" if self.integration in COMPRESSED_SOURCES else "auto_ext"

    def __post_init__(self):
        name = INTEGRATION_ALIASES.get(self.integration, self.integration)
        if name not in OBJECT_SOURCES + RECORD_SOURCES:
            raise ValueError(f"unknown integration {self.integration!r}")
        object.__setattr__(self, "integration", name)
        if self.sample < 1:
            raise ValueError("sample must be at least 1")


@dataclass(frozen=True)
class MetricConfig:
    """Settings of ``ship_metrics``."""

    application: str
    subsystem: str
    labels: dict[str, str] = field(default_factory=dict)
    batching: bool = True
    batch_target: int = BATCH_TARGET
    on_missing_inventory: str = "skip"
