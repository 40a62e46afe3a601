"""Governed, versioned datasets on Spark."""

from statlake.lake import DatasetVersion, Lake
from statlake.operators.pseudonymize import depseudonymize, pseudonymize, register_functions

__all__ = ["DatasetVersion", "Lake", "depseudonymize", "pseudonymize", "register_functions"]
