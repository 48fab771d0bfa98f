"""Settings of a model step, with their defaults and rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from tidewright.operators.asking import Flush
from tidewright.operators.control import Pace

MOST_CONCURRENT_REQUESTS = 7


@dataclass(frozen=True)
class Runtime:
    pace: Pace = field(default_factory=Pace)
    most_waves: int = 100_000
    max_request_retries: int = 3
    soft_time_limit_seconds: float = 40 * 60
    #: A wave ends by this many units, or by this many seconds, after which no task starts a request.
    units_per_wave: int = 100_000
    seconds_per_wave: float = 60
    #: Within a wave each task saves its answers by this.
    flush: Flush = field(default_factory=Flush)
    #: A bucket of the state, which is saved as a whole, has about this many units.
    units_per_bucket: int = 200_000
    #: Requests at a time are the pace's concurrency in each of so many lanes.
    lanes: int = 8
    checkpoint_every_waves: int = 10
    checkpoint_every_seconds: float = 300
    views_every_waves: int = 50
    views_every_seconds: float = 600
    release_scope: str = "unit"
    input_row_offset: int = 0
    input_row_limit: int | None = None
    write_pair_status: bool = True
    write_partial_output: bool = True
    cleanup_artifacts: bool = True
    artifact_retention_mode: str = "standard"
    keep_last: Mapping[str, int] = field(default_factory=dict)

    def __post_init__(self):
        rules = {
            "release_scope is 'unit' or 'row_complete'": self.release_scope in ("unit", "row_complete"),
            "artifact_retention_mode is 'standard' or 'debug'": self.artifact_retention_mode in ("standard", "debug"),
            "max_request_retries, input_row_offset and input_row_limit are not negative": min(self.max_request_retries, self.input_row_offset, self.input_row_limit or 0) >= 0,
            "counts of waves, units, groups and lanes are 1 at least": min(
                self.most_waves, self.units_per_wave, self.units_per_bucket, self.lanes, self.checkpoint_every_waves, self.views_every_waves, self.flush.units, self.flush.groups
            )
            >= 1,
            "seconds between savings are positive": min(self.seconds_per_wave, self.checkpoint_every_seconds, self.views_every_seconds, self.flush.seconds) > 0,
            f"max_concurrent_requests is {MOST_CONCURRENT_REQUESTS} at most": self.pace.max_concurrent_requests <= MOST_CONCURRENT_REQUESTS,
            "soft_time_limit_seconds is positive": self.soft_time_limit_seconds > 0,
            "keep_last counts are not negative": all(n >= 0 for n in self.keep_last.values()),
        }
        broken = [rule for rule, holds in rules.items() if not holds]
        if broken:
            raise ValueError("; ".join(broken))


@dataclass(frozen=True)
class ModelStep:
    """A step that fills ``outputs`` (input column -> output column) by a model."""

    name: str
    key: str
    outputs: Mapping[str, str]
    model: str
    make_adapter: Callable
    make_handler: Callable
    prompt_version: str = "v1"
    extra_outputs: tuple[str, ...] = ()
    dtypes: Mapping[str, str] = field(default_factory=dict)
    context: Mapping = field(default_factory=dict)
    runtime: Runtime = field(default_factory=Runtime)

    def __post_init__(self):
        if not self.name or not self.key or not self.outputs:
            raise ValueError("a model step has a name, a key and outputs")
        if len(set(self.columns)) != len(self.columns):
            raise ValueError("output columns repeat")

    @property
    def columns(self) -> list[str]:
        return [*self.outputs.values(), *self.extra_outputs]
