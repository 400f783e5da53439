"""Spark-native preparation, checking, modelling and scoring of labelled tables."""
