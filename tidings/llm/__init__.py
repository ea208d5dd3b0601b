"""Operators that prepare text corpora for language-model training.

One module per operator; ``queries`` registers them. Nothing outside this
package imports it.
"""
