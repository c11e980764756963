"""Modelling operators: ``DataFrame(s) + column names + parameters -> DataFrame``.

* ``cumulative`` -- C1-C9 cumulative snapshot dimensions
* ``scd``        -- S1-S9 slowly changing dimensions
* ``graph``      -- G1-G9 vertices, edges and graph reads
* ``facts``      -- D1-D4 dedupe, F1-F14 fact tables
* ``activity``   -- A1-A13 date-lists, bitmasks, reduced facts
* ``quality``    -- Q1-Q6 data-quality checks
* ``sequence``   -- skew-safe previous-event and run-length helpers
"""

from tessera.operators import activity, cumulative, facts, graph, quality, scd, sequence  # noqa: F401

__all__ = ["activity", "cumulative", "facts", "graph", "quality", "scd", "sequence"]
