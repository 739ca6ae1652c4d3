"""Skeleton (neuron tree) analytics written as Spark DataFrame programs."""
