"""Readers of the inputs."""
