"""SURVEY section 2 inventory -> implementation -> registered queries.

Checked by tests: every query named here is registered, and every registered query
appears here.
"""

COVERAGE: dict[str, tuple[str, list[str]]] = {
    # sources and sinks
    "S1": ("sources.files.read_tsv_manifest, sources.splitscan.read_tsv_splits", ["manifest_from_tsv", "manifest_quarantine", "manifest_tsv_splits"]),
    "S2": ("sources.files.read_jsonl (+ with_file_order when no position is stored)",
           ["manifest_jsonl", "stream_text_tokens", "manifest_quarantine", "file_order"]),
    "S3": ("sources.files.write_jsonl", ["manifest_jsonl"]),
    "S4": ("sources.archives.unpack_archives (+ write_archives), sources.splitscan.index_archives / read_members", ["archive_members", "archive_ranges"]),
    "S5": ("sources.audio.read_audio (+ write_wavs sink), sources.chunks.read_chunks", ["audio_files", "chunked_resample"]),
    "S6": ("sources.files.write_artifact / read_artifact, write_bucketed_artifact",
           ["artifact_store", "stream_text_tokens", "training_samples_bucketed"]),
    "S7": ("sources.requests.sidecar_json / write_sidecars", ["sidecars", "sidecar_files"]),
    "S8": ("functions.requests.parse_request, streaming.requests", ["parse_requests", "stream_requests"]),
    "S9": ("operators.aggregates.distinct_dirs + URL projection", ["archive_list"]),
    # projections and scalars
    "P1": ("functions.text.normalize_text", ["normalize_text", "normalize_turns"]),
    "P2": ("functions.text.wide_chars", ["wide_chars"]),
    "P3": ("functions.text.artifact_path", ["artifact_paths"]),
    "P4": ("functions.text.parent_dirs", ["parent_dirs"]),
    "P5": ("functions.text.result_name", ["result_names"]),
    "P6": ("functions.text.tagged_output_path", ["enhanced_paths"]),
    "P7": ("functions.text.ensure_suffix", ["wav_suffix"]),
    "P8": ("functions.text.cache_key", ["cache_keys"]),
    "P9": ("functions.requests.parse_request", ["parse_requests"]),
    "P10": ("functions.requests.slider_value", ["request_knobs"]),
    "P11": ("functions.requests.validation_error / cut_text", ["validate_requests"]),
    "P12": ("functions.requests.is_long_text", ["validate_requests"]),
    "P13": ("functions.requests.choose_reference", ["choose_reference"]),
    "P14": ("functions.requests.duration_filter / synthesis_error", ["durations", "resampled_audio"]),
    "P15": ("functions.requests.cap_samples / cap_waveform", ["durations"]),
    "P16": ("functions.text.infer_format", ["infer_format"]),
    "P17": ("operators.vectors.check_embedding_dims", ["embedding_dims"]),
    "P18": ("operators.metrics.metric_names", ["metric_keys"]),
    # joins
    "J1": ("operators.joins.assemble_samples / admit", ["sample_admission", "training_samples", "training_batches", "training_samples_bucketed"]),
    "J2": ("operators.joins.pending, sources.keyindex.KeyedStore.pending", ["pending_embeddings", "artifact_store", "indexed_resume"]),
    "J3": ("operators.joins.memoize, sources.keyindex.memoize_in", ["memoized_quality", "indexed_memo"]),
    "J4": ("operators.joins.zip_results", ["zip_results"]),
    "J5": ("operators.joins.guide, operators.vocab.guide", ["guided_scores", "guided_arrays", "sampled_tokens_a"]),
    "J6": ("operators.joins.resolve_preset", ["choose_reference", "stream_requests"]),
    "J7": ("operators.joins.missing_artifacts", ["missing_artifacts"]),
    # aggregations
    "A1": ("operators.aggregates.distinct_dirs", ["distinct_dirs"]),
    "A2": ("operators.aggregates.manifest_count", ["manifest_count"]),
    "A3": ("operators.collate.batch_shape", ["batch_shapes"]),
    "A4": ("operators.vectors.utterance_embedding", ["utterance_embeddings"]),
    "A5": ("operators.vectors.speaker_embedding, plans.corpus.speaker_vectors", ["speaker_embeddings", "speaker_from_audio"]),
    "A6": ("operators.metrics.eval_mean_of_means", ["eval_loss"]),
    "A7": ("operators.metrics.merge_rank_lists", ["merged_rank_lists"]),
    "A8": ("operators.metrics.reduce_metrics", ["reduced_metrics"]),
    "A9": ("operators.metrics.masked_nll / masked_nll_mean", ["masked_nll"]),
    "A10": ("operators.metrics.throughput_metrics, operators.percentiles.day_sketches / merge_sketches", ["throughput", "throughput_percentiles"]),
    "A11": ("operators.aggregates.batch_token_len", ["batch_token_len"]),
    "A12": ("operators.aggregates.hierarchy_lengths", ["hierarchy_lengths"]),
    # windows and ordered operators
    "O1": ("operators.position.with_position, operators.append.PositionLog", ["positions_by_length", "fixed_batches", "appended_positions"]),
    "O2": ("operators.position.assign_shard / shard_range", ["shards"]),
    "O3": ("operators.position.tail_split / split_bounds", ["splits_overlap", "splits_disjoint", "prepared_corpus"]),
    "O4": ("operators.position.fixed_batches", ["fixed_batches", "batch_shapes", "training_batches"]),
    "O5": ("operators.position.shuffled_batches, operators.permute.permuted_batches", ["shuffled_batches", "permuted_batches"]),
    "O6": ("operators.position.length_sorted_batches, operators.budget.budget_batches",
           ["length_sorted_batches", "prompt_batches", "token_budget_batches"]),
    "O7": ("operators.position.first_wins, streaming.firsts.FirstPosition", ["first_turns", "stream_text_tokens", "stream_first_positions"]),
    "O8": ("operators.sampling.softmax, operators.vocab.softmax", ["softmax_scores", "softmax_arrays"]),
    "O9": ("operators.sampling.top_k_mask, operators.vocab.top_k", ["top_k_scores", "top_k_arrays"]),
    "O10": ("operators.sampling.top_p_filter (A, B), operators.vocab.top_p, top_p_b",
            ["top_p_a", "top_p_b", "top_p_arrays", "top_p_b_arrays"]),
    "O11": ("operators.sampling.draw_one, operators.vocab.draw", ["drawn_tokens", "drawn_arrays"]),
    "O12": ("operators.segments.segment_windows", ["segment_windows", "partial_mels"]),
    "O13": ("functions.tokens.mask_after_marker", ["marker_masks"]),
    # sorts, limits, sets
    "L1": ("operators.position.order_restore", ["restored_order"]),
    "L2": ("functions.tokens.stage1_input / stage1_target (max_len)", ["training_batches"]),
    "L3": ("functions.tokens.crop_context", ["cropped_context"]),
    "L4": ("functions.tokens.take_until / generation_budget", ["take_until_eoa"]),
    "L5": ("operators.aggregates.length_guard", ["length_guard"]),
    "G1": ("operators.sets.union_outputs", ["split_union", "memoized_quality"]),
    "G2": ("operators.sets.split_leakage", ["split_leakage"]),
    "G3": ("operators.sets.repeat_samples", ["repeated_samples"]),
    # token sequences
    "T1": ("functions.tokens.interleave", ["interleaved_codes"]),
    "T2": ("functions.tokens.stage1_input", ["training_batches", "collate_full"]),
    "T3": ("functions.tokens.stage1_target", ["training_batches", "collate_full", "null_pad_targets"]),
    "T4": ("functions.tokens.pad_right / pad_codes", ["training_batches"]),
    "T5": ("operators.collate.collate", ["training_batches", "collate_full"]),
    "T6": ("functions.tokens.deinterleave", ["deinterleaved"]),
    "T7": ("functions.tokens.untilt", ["untilted"]),
    "T8": ("functions.tokens.fill_codebooks", ["filled_codebooks"]),
    "T9": ("functions.tokens.stage2_input", ["stage2_inputs"]),
    "T10": ("functions.tokens.prompt_rows / pad_rows", ["prompt_batches"]),
    "T11": ("functions.tokens.prefix_mask", ["prefix_masks"]),
    "T12": ("functions.tokens.overlay", ["overlays"]),
    "T13": ("functions.tokens.stack_hierarchies", ["stacked_hierarchies"]),
    "T14": ("functions.tokens.shift_ids", ["text_tokens", "text_roundtrip"]),
    "T15": ("operators.sampling.scale_logits, operators.vocab.scale", ["scaled_logits", "sampled_arrays"]),
    "T16": ("operators.sampling.sample_tokens (A, B), operators.vocab.sample",
            ["sampled_tokens_a", "sampled_tokens_b", "sampled_arrays", "sampled_arrays_a", "sampled_arrays_b"]),
    "T17": ("operators.sampling.embedding_dropout", ["embedding_dropout"]),
    "T18": ("functions.tokens.gather", ["gathered_embeddings"]),
    "T19": ("functions.tokens.null_pad_tokens", ["null_pad_targets"]),
    "T20": ("operators.vectors.l2_normalize", ["normalized_embeddings"]),
    "T21": ("operators.segments.padded_length (+ padding in sources.audio.partial_mels)", ["padded_lengths"]),
    "T22": ("operators.sampling.double_batch", ["double_batch"]),
    # Python workers
    # the SQL form's queries; bpe_tokens and bpe_roundtrip only cross-check them
    "U1": ("functions.tokens.byte_tokens (SQL), operators.models.bpe_encode / bpe_decode",
           ["text_tokens", "text_roundtrip", "bpe_tokens", "bpe_roundtrip"]),
    "U2": ("operators.models.map_model", ["model_scores"]),
    "U3": ("sources.audio.resample_audio, sources.chunks.resample_chunks", ["resampled_audio", "chunked_resample"]),
    "U4": ("sources.audio.trim_audio, sources.chunks.trim_chunks", ["trimmed_audio", "chunked_trim"]),
    "U5": ("sources.audio.mel_spectrogram, sources.chunks.mel_chunks", ["mel_frames", "chunked_mels"]),
    "U6": ("sources.audio.partial_mels, sources.chunks.partial_chunks", ["partial_mels", "chunked_partials"]),
    # streaming
    "R1": ("streaming.requests.prepare_requests / stream_prepare_requests / stream_requests_once", ["stream_requests", "stream_requests_once"]),
    "R2": ("streaming.requests.split_dead_letters", ["stream_dead_letters", "stream_requests_once"]),
    "R3": ("streaming.incremental.stream_text_tokens (table, index or state dedupe)",
           ["stream_text_tokens", "stream_text_tokens_index", "stream_text_tokens_state", "stream_first_positions"]),
}
