"""Category labels derived from numeric measures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from playspan import fixed


def track_mood(valence: Column, energy: Column) -> Column:
    """Mood of a track. The band between the two cut points is neutral."""
    happy, sad = valence >= fixed.TRACK_MOOD_HIGH, valence < fixed.TRACK_MOOD_LOW
    lively, calm = energy >= fixed.TRACK_MOOD_HIGH, energy < fixed.TRACK_MOOD_LOW
    return _mood(happy, sad, lively, calm)


def playlist_mood(valence: Column, energy: Column) -> Column:
    """Mood of a playlist: energy splits at a single point."""
    happy, sad = valence >= fixed.PLAYLIST_MOOD_HIGH, valence < fixed.PLAYLIST_MOOD_LOW
    lively, calm = energy >= fixed.PLAYLIST_MOOD_HIGH, energy < fixed.PLAYLIST_MOOD_HIGH
    return _mood(happy, sad, lively, calm)


def _mood(happy: Column, sad: Column, lively: Column, calm: Column) -> Column:
    return (
        F.when(happy & lively, fixed.MOOD_HAPPY_ENERGETIC)
        .when(happy & calm, fixed.MOOD_HAPPY_CALM)
        .when(sad & lively, fixed.MOOD_SAD_ENERGETIC)
        .when(sad & calm, fixed.MOOD_SAD_CALM)
        .otherwise(fixed.MOOD_NEUTRAL)
    )


def mode_label(mode: Column) -> Column:
    """0 and 1 have names, anything else is NULL."""
    return F.when(mode == 0, "Minor").when(mode == 1, "Major")
