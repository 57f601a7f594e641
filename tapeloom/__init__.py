"""Market-data archives on Spark: capture, history load, daily normalisation, inspection."""

from tapeloom.session import build_session

__all__ = ["build_session"]
