"""Run-statistics kernels (flat and nested), metric derivation, semi-join restriction."""
