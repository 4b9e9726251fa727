"""The five reports, composed from the operators."""
