"""Training-data operators: ten operators on text, pages, chats and vectors, each in a module of its own.

Nothing else in the library imports this subpackage; ``registry`` lists its queries.
"""
