"""Training-data operators: mixing, token files, near duplicates, archives, chat, cleaning, scoring, scanning.

Nothing else in the library imports this subpackage. The registered queries are in
``censusmart.llm.queries``; the five-stage corpus job is ``corpus_pipeline.py`` at the repository top.
"""
