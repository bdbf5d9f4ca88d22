"""Deriving, scanning and storing bars."""
