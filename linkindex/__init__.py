"""Linked-entity index built with Spark DataFrames: match, number, link, derive, publish."""
