"""Spark jobs for archiving discussion forums and preparing their text."""
