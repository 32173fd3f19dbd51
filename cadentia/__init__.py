"""Cadence analytics on Spark: DataFrame operators for ON/OFF spectrogram cadences."""

from cadentia.geometry import Geometry
from cadentia.session import build_session, materialise, scratch_dir

__all__ = ["Geometry", "build_session", "materialise", "scratch_dir"]
