"""Double-typed output columns of each query that has a SQL oracle.

Both engines round these to 6 decimals before results are compared, so last-bit differences of
floating sums (different summation orders) never decide a comparison. Regenerate after a schema change
(a stale entry only leaves a column unrounded on the SQL side; tools/oracle_check.py shows it).
"""

DOUBLE_COLUMNS = {
    'x4_neighbour_information': ['mutual_info'],
    's8_reports': ['value'],
    'v2_grouped_metrics': ['n', 'accuracy', 'precision', 'recall', 'f1', 'roc_auc', 'average_precision'],
    's10_results_dir': ['accuracy', 'f1', 'npv', 'precision', 'recall', 'specificity', 'threshold'],
    'f10_processing_report': ['value'],
    'f2_feature_target_separation': ['positive_rate'],
    'a21_insights': ['value'],
    'a10_correlation_matrix': ['corr'],
    'a11_high_correlation_pairs': ['corr'],
    'a12_usage_summary': ['usage_pct', 'user_rate_pct'],
    'a13_summary_correlation': ['corr'],
    'a14_rates_by_change_columns': ['share', 'rate'],
    'a15_code_group_rates': ['share', 'rate'],
    'a15_code_pair_rates': ['rate', 'share'],
    'a16_highest_risk_group': ['rate'],
    'a17_group_gap': ['rate_a', 'rate_b', 'gap'],
    'a18_label_ratios': ['any_pct', 'early_pct', 'early_late_ratio'],
    'a19_histogram': ['lo', 'hi'],
    'a19_mean_median': ['mean', 'median'],
    'a1_rate_by_category': ['rate', 'share'],
    'a20_box_stats': ['q1', 'median', 'q3', 'whisker_lo', 'whisker_hi'],
    'a23_best_model': ['brier', 'roc_auc'],
    'a25_mean_of_group_rates': ['mean_rate_pct'],
    'a26_overall': ['rate', 'mean_stay'],
    'a2_rate_by_disposition_first_visits': ['rate', 'share'],
    'a2_top_descriptions': ['rate', 'share'],
    'a3_two_key_rates': ['rate', 'share'],
    'a4_rate_pivot': ['F', 'O', 'P'],
    'a6_column_stats': ['mean', 'median', 'mode', 'std', 'min', 'max', 'q1', 'q3', 'corr_target'],
    'a7_class_means': ['mean_0', 'mean_1', 'pct_diff'],
    'a8_t_statistic': ['t_stat'],
    'a9_strongest_predictor': ['abs_corr'],
    'a9_target_correlations': ['corr', 'abs_corr'],
    'b10_class_balance': ['share', 'imbalance_ratio'],
    'b12_nulls_per_row': ['mean'],
    'b13_value_distribution': ['pct'],
    'b14_iqr_outliers': ['q1', 'q3', 'iqr', 'lower', 'upper', 'outlier_pct'],
    'b15_quality_score': ['mean_missing_pct', 'duplicate_pct', 'quality_score'],
    'b18_validate_clean': ['value'],
    'b19_before_after': ['before', 'after'],
    'b21_describe': ['mean', 'std', 'min', 'q25', 'q50', 'q75', 'max'],
    'b5_table_rules': ['value'],
    'b6_missing_profile': ['missing_pct'],
    'b7_missing_ranking': ['missing_pct'],
    'b7_missing_totals': ['null_pct'],
    'b8_special_tokens': ['pct'],
    'f3_split_balance': ['rate', 'max_gap'],
    'f4_standard_scaling': ['time_in_hospital', 'num_lab', 'num_med', 'num_proc', 'total_procedures'],
    'f5_scaling_drift': ['train_mean', 'test_mean', 'train_std', 'test_std', 'mean_gap'],
    'f6_vector_pipeline': ['feature_sum'],
    'f8_balanced_weights': ['weight'],
    'j2_coverage': ['coverage'],
    'm10_score_distribution': ['mean', 'std', 'separation'],
    'm12_class_distribution': ['share'],
    'm13_score_histogram': ['lo', 'hi'],
    'm1_confusion_normalized': ['tn_rate', 'fp_rate', 'fn_rate', 'tp_rate'],
    'm2_classification_metrics': ['threshold', 'accuracy', 'precision', 'recall', 'f1', 'specificity', 'npv'],
    'm3_metrics_at_0_7': ['threshold', 'accuracy', 'precision', 'recall', 'f1', 'specificity', 'npv'],
    'm4_roc_auc': ['roc_auc'],
    'm4_roc_auc_model2': ['roc_auc'],
    'm5_average_precision': ['average_precision'],
    'm5_losses': ['log_loss', 'brier'],
    'm6_curve_points': ['threshold', 'pos', 'neg', 'tp', 'fp', 'tpr', 'fpr', 'precision', 'recall', 'f1'],
    'm7_best_f1_threshold': ['threshold', 'f1', 'precision', 'recall'],
    'm7_rank_summary': ['roc_auc', 'average_precision', 'best_threshold', 'best_f1'],
    'm8_constrained_thresholds': ['threshold', 'value'],
    'm9_sweep_best': ['threshold', 'value'],
    'm9_threshold_sweep': ['threshold', 'f1', 'precision', 'recall', 'accuracy'],
    'p10_near_unique': ['ratio'],
    'p11_drop_for_modelling': ['num_lab', 'total_procedures'],
    'p14_filter_top_n': ['rate'],
    'p16_configured_clean': ['rate', 'num_lab_sum'],
    'p3_drop_report': ['missing_pct'],
    'p4_sentinel_counts': ['pct'],
    'p6_derived_means': ['medication_changed', 'total_procedures', 'long_stay'],
    'p7_negative_medians': ['median'],
    'p7_negative_repair': ['num_lab_sum'],
    'p9_drop_id_twins': ['num_lab', 'total_procedures'],
    's3_head_sample': ['o_totalprice'],
    'v2_cv_summary_fixed_score': ['mean', 'std', 'min', 'max', 'stability'],
    'v6_bootstrap_summary': ['mean', 'std', 'median', 'p2_5', 'p97_5'],
    'v6_metric_bootstrap': ['accuracy', 'precision', 'recall'],
    'v9_verdicts_fixed_score': ['mean', 'std'],
    'w4_rank_positions': ['abs_corr'],
    'x3_anova_f': ['f_stat', 'df_between', 'df_within'],
    'x4_mutual_information': ['mutual_info'],
    'x6_vif': ['vif'],
    'x7_interaction_screen': ['corr'],
}
