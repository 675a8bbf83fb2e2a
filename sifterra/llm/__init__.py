"""Operators for text that trains language models. Nothing outside this subpackage imports it."""
