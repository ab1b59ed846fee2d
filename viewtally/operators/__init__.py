"""Lazy DataFrame operators. None runs an action except where it says so."""
