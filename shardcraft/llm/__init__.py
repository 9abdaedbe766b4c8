"""Operators for preparing training data at scale.

Nothing outside this package imports it.  Each module holds one operator with
its general interface; :mod:`.queries` registers the thin digest queries.
"""
