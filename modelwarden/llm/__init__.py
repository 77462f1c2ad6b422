"""Operators of a training-data pipeline over text and vectors; nothing outside this folder imports them."""
