"""Operations of training-data pipelines: texts, pages and vectors as Spark jobs.

Nothing else in the library imports this subpackage.
"""
