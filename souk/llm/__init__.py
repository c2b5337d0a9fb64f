"""Operations of a large-scale training-data pipeline.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
Each module holds one operator with its general interface; ``queries`` holds
the thin ``opN_<name>`` queries over the benchmark tables.
"""
