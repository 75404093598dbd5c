"""quillmark: find, link and monitor mentions of curated items in text and web corpora, on Spark DataFrames.

operators/  relational and record-level operators
functions/  column functions (URL, text, date, vector)
sources/    readers
streaming/  append-log operators on Structured Streaming
plans/      named queries over the test tables, with their SQL
llm/        operators of training-data pipelines; nothing outside imports it
"""
