"""Column functions: built-ins wherever these express the semantics, Arrow UDFs for the rest (see register)."""

from marlstone.functions.registry import register

__all__ = ["register"]
