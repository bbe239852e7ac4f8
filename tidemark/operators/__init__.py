"""DataFrame -> DataFrame operators.

series    tie-safe series features (E1-E6), routed by series size
profile   grouped profiles and counting aggregates (D1-D8)
reshape   pivot, unpivot, stacking, distinct values (G1-G4)
bars      bar normalising, one-pass repair, metrics, dashboard summaries (B1-B6, B10, F1, E7-E10, D11, D12)
merge     keyed upsert, fingerprints, staleness (A7, A10, A11, C3, C4, C6, D13)
serve     serving queries (B7-B15, C5, D3, D4, D9, D10, E11, F2-F6, G1)
checks    data-quality checks (K1-K10, C1, C2, A12, E12)
joins     size-checked broadcast joins
"""
