"""Timetable reliability analytics as Spark DataFrame operators."""
