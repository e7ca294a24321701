"""Profiling, encoding and synthesis of tabular data as Spark jobs."""

from strataloom.config import Bias, Distribution, ModelConfig, Privacy, Synthetic
from strataloom.errors import InvalidRequestError, NotReadyError, StrataError
from strataloom.log import disable_logging, enable_logging
from strataloom.operators.sampler import Model, fit, generate, generate_sequences, impute, synthesize
from strataloom.operators.tables import Table, synthesize_tables

__all__ = ["Bias", "Distribution", "InvalidRequestError", "Model", "ModelConfig", "NotReadyError", "Privacy", "StrataError", "Synthetic", "Table", "disable_logging", "enable_logging", "fit", "generate", "generate_sequences", "impute", "synthesize", "synthesize_tables"]
