"""lexweave: document analytics on Spark DataFrames.

Raw text is cleaned, split into chapters, articles, annexes, sections, paragraphs, points, lists and tables with
stable ids, and packed into retrieval chunks. Every operator is a function from DataFrames to DataFrames.
"""

__version__ = "0.1.0"
