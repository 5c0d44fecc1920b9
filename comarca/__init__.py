"""Comarca: registry-file cleaning and regional analytics on Spark DataFrames.

Layers, lowest first:

``functions``  column expressions (text, numbers, labels)
``operators``  DataFrame -> DataFrame operators, parameterised by column names
``sources``    readers, writers and the scratch location
``plans``      the regional tables and reports, built from the layers below
``queries``    the same work run over the test tables, each with a SQL twin
"""
