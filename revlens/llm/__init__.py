"""Operators for preparing text corpora for language-model training.

Nothing outside this package imports it.  ``revlens.llm.registry`` holds the
registered queries, ``revlens.llm.oracles`` the SQL of those that SQL can
express.
"""
