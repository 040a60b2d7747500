"""Training-data operators. Nothing else in the library imports this subpackage.

Each ``*.py`` module holds one operator with a general interface; ``queries`` binds
them to the tables of a data directory. Modules are imported on demand so that Python
workers load only what a task needs.
"""
