"""Spark jobs that build, look up and search a lake of long text documents."""

from folioloom.lake import CorpusLake
from folioloom.paths import LakePaths
from folioloom.session import build_session, new_folder

__all__ = ["CorpusLake", "LakePaths", "build_session", "new_folder"]
