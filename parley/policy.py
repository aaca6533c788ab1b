"""Thresholds of the operators; fixed values, in milliseconds unless named otherwise."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class WindowPolicy:
    gap: int = 15_000
    least: int = 20_000
    most: int = 900_000
    before: int = 250
    after: int = 250

    def __post_init__(self) -> None:
        if self.most < self.least or min(self.gap, self.before, self.after) < 0 or self.least <= 0:
            raise ValueError("window bounds are out of order")


@dataclass(frozen=True)
class QualityPolicy:
    least_snr_db: float = 10.0
    most_music: float = 0.3
    absorb_below: int = 3_000
    least_region: int = 20_000
    music_probability: float = 0.2
    music_gap: int = 600
    music_least: int = 2_000

    def __post_init__(self) -> None:
        if not (0 <= self.most_music <= 1 and 0 <= self.music_probability <= 1):
            raise ValueError("shares lie between 0 and 1")
        if self.least_snr_db < 0 or min(self.music_gap, self.music_least) < 0 or min(self.absorb_below, self.least_region) <= 0:
            raise ValueError("quality bounds are out of order")


@dataclass(frozen=True)
class PlannerPolicy:
    least_window: int = 20_000
    most_window: int = 60_000
    speaker_turn: int = 4_000
    speaker_total: int = 8_000
    backchannel: int = 1_500
    monologue: int = 40_000
    rounds: int = 200

    def __post_init__(self) -> None:
        if not 0 < self.least_window <= self.most_window:
            raise ValueError("window bounds are out of order")
        if self.speaker_turn > self.speaker_total:
            raise ValueError("a speaker's turn is no longer than the total")


@dataclass(frozen=True)
class ReferencePolicy:
    trim: int = 500
    least_segment: int = 4_000
    most_effective: int = 30_000
    least_effective: int = 4_000


@dataclass(frozen=True)
class SlicePolicy:
    gap: int = 2_000
    pad: int = 500

    def __post_init__(self) -> None:
        if self.pad < 0 or 2 * self.pad > self.gap:
            raise ValueError("padded slices would overlap")


@dataclass(frozen=True)
class UtterancePolicy:
    huge_gap: int = 2_000
    clause: int = 2_000
    medium: int = 10_000
    medium_gap: int = 600
    emergency: int = 20_000
    emergency_gap: int = 80
    word_most: int = 2_000
    word_capped: int = 300


@dataclass(frozen=True)
class DialoguePolicy:
    turn_gap: int = 250
    overlap: int = 400
    own_gap: int = 80
    rate: int = 44_100


@dataclass(frozen=True)
class SeparationPolicy:
    initial: int = 20_000
    extension: int = 5_000
    most: int = 120_000
    overlap: int = 10_000
    crossfade: int = 5_000

    def __post_init__(self) -> None:
        if not (0 <= self.crossfade <= self.overlap < self.initial <= self.most) or self.extension <= 0:
            raise ValueError("window bounds are out of order")
