"""Operators for preparing large text corpora: each module holds one of them.

``quaybook.llm.queries`` lists the registered queries; nothing outside this
subpackage imports it.
"""
