"""Whole jobs, each one lazy DataFrame chain."""
