"""Trip-record analytics on Spark DataFrames."""

from tripkit.schemas import FHV, FHVHV, GREEN, PROFILES, SERVICES, YELLOW
from tripkit.session import apply_settings, build_session, shared_dir

__all__ = [
    "FHV", "FHVHV", "GREEN", "PROFILES", "SERVICES", "YELLOW",
    "apply_settings", "build_session", "shared_dir",
]
