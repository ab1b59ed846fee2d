"""The daily reports: each is a parameter set of the operators.

``registry`` collects them; ``standins`` maps the test tables to the logs and
dimensions that the reports read.
"""
