"""Labelled-text quality, features and classification as Spark DataFrame jobs."""

from mailsieve import settings

__all__ = ["settings"]
__version__ = "0.1.0"
