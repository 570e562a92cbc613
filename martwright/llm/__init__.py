"""Operators for preparing large training corpora.

One module per operator; ``queries`` registers them.  Nothing outside this
subpackage imports it.
"""
