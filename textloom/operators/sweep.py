"""Declared and effective configuration of the runs of a sweep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults of a run's options.
DEFAULTS = {
    "train_test_split": "0.9",
    "learning_rate": "0.0002",
    "num_epochs": "3",
    "max_length": "512",
    "seed": "42",
    "start_batch_size": "1",
    "max_batch_size": "128",
    "safe_batch_size": "8",
    "base_grad_accum": "32",
    "flash_attention": "true",
    "sdpa_attention": "true",
    "lora_r": "8",
    "lora_alpha": "32",
    "lora_dropout": "0.1",
    "lora_target_modules": "q_proj,k_proj,v_proj,o_proj",
    "load_in_4bit": "true",
    "load_in_8bit": "false",
    "use_fp16": "true",
    "use_bf16": "false",
    "compile_model": "false",
    "use_gradient_checkpointing": "true",
    "use_8bit_optimizer": "true",
    "use_double_quant": "true",
    "logging_steps": "10",
    "eval_steps": "100",
    "save_steps": "500",
    "save_total_limit": "1",
    "use_wandb": "false",
    "wandb_project": "llama-finetuning",
    "wandb_tags": "",
}

# The named runs and what they change; "false" declares a switch as left out.
RUNS = {
    "exp1_all_optimizations": {},
    "exp2_lora_only": {"load_in_4bit": "false", "use_8bit_optimizer": "false", "use_double_quant": "false"},
    "exp3_8bit_quantization": {"load_in_4bit": "false", "load_in_8bit": "true", "use_double_quant": "false"},
    "exp4_higher_lora_rank": {"lora_r": "16", "lora_alpha": "64"},
    "exp5_bf16_precision": {"use_fp16": "false", "use_bf16": "true"},
    "exp6_max_batch_size": {
        "num_epochs": "1",
        "start_batch_size": "16",
        "max_batch_size": "256",
        "safe_batch_size": "32",
    },
    "exp7_higher_lr": {"learning_rate": "0.0005"},
    "exp8_different_modules": {"lora_target_modules": "q_proj,v_proj"},
}


def sweep_grid(spark: SparkSession, runs: dict | None = None, defaults: dict | None = None) -> DataFrame:
    """``(name, overrides, declared, effective)`` for every run.

    Switches that are on by default can only be set, never cleared, so the effective configuration keeps
    them on whatever the run declares.
    """
    defaults = DEFAULTS if defaults is None else defaults
    rows = [(name, overrides) for name, overrides in (RUNS if runs is None else runs).items()]
    grid = spark.createDataFrame(rows, "name string, overrides map<string,string>")
    base = F.create_map(*[F.lit(x) for pair in defaults.items() for x in pair])
    always_on = [key for key, value in defaults.items() if value == "true"]

    def over(base, changes):
        kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(changes, k))
        return F.map_concat(kept, changes)

    settable = F.map_filter("overrides", lambda k, v: ~(k.isin(always_on) & (v == "false")))
    return grid.select(
        "name", "overrides", over(base, F.col("overrides")).alias("declared"), over(base, settable).alias("effective")
    )
