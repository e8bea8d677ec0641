"""Registered queries over the driver's tables, each with an independent SQL form where one exists."""
